"""Positions of the first violation in annotation documents; expected lines and columns by a small stack parser."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.sources import positions as P

HEAD = """<?xml version="1.0" encoding="UTF-8"?>\r
<SIGNSTREAM-DATABASE DATABASE-VERSION="1.0">\r
  <!-- a <comment> that
       goes on -->
  <PARTICIPANTS>
    <PARTICIPANT AGE="22" GENDER="male" ID="0" LABEL="M" LANGUAGE="ASL" NAME="A &gt; B"/>
  </PARTICIPANTS>
  <CODING-SCHEME>
    <FIELD ID="1" NAME="gloss">
      <VALUE ID="6" NAME="x"/>
      <VALUE ID="7" NAME="y > z"/>
    </FIELD>
    <FIELD ID="2" NAME="other"><VALUE ID="6" NAME="x"/></FIELD>
    <VALUE_COLLECTION><VALUE NAME="no id"/></VALUE_COLLECTION>
  </CODING-SCHEME>
  <MEDIA-FILES><MEDIA-FILE ID="479" LEGACY-PATH="a:b.mov"/></MEDIA-FILES>
  <UTTERANCE E="9" ID="63" S="1">
    <MEDIA-REF ID="479"/>
    <SEGMENT PARTICIPANT-ID="0">
      <TRACK FID="1"><A S="0" E="3" VID="6">-</A>
      <A S="3" E="4">wörd</A></TRACK>
    </SEGMENT>
  </UTTERANCE>
</SIGNSTREAM-DATABASE>
"""

#: (what is replaced, by what, cause, element, the text at whose beginning it is reported)
CASES = [
    ("  </PARTICIPANTS>", '    <PARTICIPANT ID="0" NAME="twice">\n    </PARTICIPANT>\n  </PARTICIPANTS>', "duplicate participant", "PARTICIPANT", '<PARTICIPANT ID="0" NAME="twice"'),
    ('<FIELD ID="2"', '<FIELD ID="1"', "duplicate field", "FIELD", '<FIELD ID="1" NAME="other"'),
    ('<VALUE ID="7"', '<VALUE ID="06"', "duplicate field value", "VALUE", '<VALUE ID="06"'),
    ("</MEDIA-FILES>", '\n<MEDIA-FILE ID="479" LEGACY-PATH="c"/></MEDIA-FILES>', "duplicate media", "MEDIA-FILE", '<MEDIA-FILE ID="479" LEGACY-PATH="c"'),
    ("    </SEGMENT>\n", '    </SEGMENT>\n    <SEGMENT PARTICIPANT-ID="0" X="">\n    </SEGMENT>\n', "duplicate utterance", "SEGMENT", '<SEGMENT PARTICIPANT-ID="0" X=""'),
    ('<MEDIA-REF ID="479"/>', '<MEDIA-REF ID="480"/>', "unknown media", "MEDIA-REF", '<MEDIA-REF ID="480"'),
    ("<TRACK FID", "<STRANGE/><TRACK FID", "unexpected element", "STRANGE", "<STRANGE"),
    ("  <MEDIA-FILES>", '  <MEDIA-REF ID="479"/>\n  <MEDIA-FILES>', "unexpected element", "MEDIA-REF", '<MEDIA-REF ID="479"/>\n  <MEDIA-FILES>'),
    ("</A></TRACK>", "</TRACK></A>", "wrong nesting", "TRACK", "</TRACK></A>"),
    ("</SIGNSTREAM-DATABASE>", "</SIGNSTREAM-DATABASE></UTTERANCES>", "wrong nesting", "UTTERANCES", "</UTTERANCES>"),
    ('<A S="3" E="4">', '<A S="3" E="4"', "unclosed tag", "A", '<A S="3" E="4"wörd'),
    ('<A S="3" E="4">', '<A S="3" E="four">', "bad attribute", "A", '<A S="3" E="four"'),
    ('<SEGMENT PARTICIPANT-ID="0">', "<SEGMENT>", "bad attribute", "SEGMENT", "<SEGMENT>"),
    ("</UTTERANCE>\n</SIGNSTREAM-DATABASE>\n", "", "unclosed element", "UTTERANCE", None),
    ("</SIGNSTREAM-DATABASE>\n", "", "unclosed element", "SIGNSTREAM-DATABASE", None),
]


def place(text, at):
    """Line from 1 and column from 0 of a text's character."""
    return text.count("\n", 0, at) + 1, at - (text.rfind("\n", 0, at) + 1)


@pytest.fixture(scope="module")
def found(spark):
    rows = [(-1, HEAD), (-2, None), (-3, ""), (-4, "words only"), (-5, HEAD.replace("<FIELD ID=\"2\"", "<![CDATA[ <A> ]]><FIELD ID=\"2\"")), (-6, HEAD.replace("\n", "\n\n" * 500))]
    rows += [(n, HEAD.replace(old, new, 1)) for n, (old, new, *_) in enumerate(CASES)]
    texts = dict(rows)
    got = P.errors(spark.createDataFrame(rows, "DocumentID int, xml string").repartition(3))
    return texts, {r.DocumentID: r for r in got.collect()}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_position(found, n):
    texts, got = found
    _, _, cause, element, where = CASES[n]
    text = texts[n]
    at = len(text) if where is None else text.index(where)
    assert (got[n].cause, got[n].element) == (cause, element)
    assert (got[n].line, got[n].column) == place(text, at)


def test_good_and_empty_documents(found):
    _, got = found
    assert not {-1, -2, -5, -6} & set(got)
    assert (got[-3].cause, got[-3].line, got[-3].column) == ("no root", 1, 0) and (got[-4].cause, got[-4].column) == ("no root", 10)


def test_ignored_causes(spark):
    df = spark.createDataFrame([(1, HEAD.replace('<MEDIA-REF ID="479"/>', '<MEDIA-REF ID="480"/>').replace("</A></TRACK>", "</TRACK></A>"))], "DocumentID int, xml string")
    assert P.errors(df, ignore=("unknown media",)).first().cause == "wrong nesting" and P.errors(df).first().cause == "unknown media"


def test_many_tags(spark):
    """A long document: the violation near its end is found, where a stack parser finds it."""
    body = "".join(f'<A S="{i}" E="{i + 1}">w{i}</A>\n' for i in range(20_000))
    text = HEAD.replace("</A></TRACK>", "</A>" + body + "</TRACK>").replace("</SEGMENT>", "</SEGMENTS>")
    row = P.errors(spark.createDataFrame([(1, text)], "DocumentID int, xml string")).first()
    stack = []
    for m in re.finditer(P.TAG.replace(r"\z", r"\Z"), text):
        tag = m.group()
        if tag.startswith(("<!", "<?")) or tag.endswith("/>"):
            continue
        if not tag.startswith("</"):
            stack.append(re.match(r"<([^\s>]+)", tag)[1])
        elif stack.pop() != tag[2:-1]:
            break
    assert (row.cause, row.element, row.line, row.column) == ("wrong nesting", "SEGMENTS", *place(text, m.start()))


def test_proof_of_plain_texts(spark):
    """What is proved right has no violation by the fold; usual documents are proved, and changed ones judged alike."""
    usual = re.sub(r"(?s)<!--.*?-->|    <VALUE_COLL[^\n]*\n", "", HEAD).replace("y > z", "y &gt; z").replace("wörd</A>", 'wörd</A><A S="-1" E="2"/>')
    cut = re.findall(r"<[^<>]*>|[^<]+", usual)
    draw, rows = random.Random(5), [(-1, usual), (-2, usual.replace("\n", ""))]
    for n in range(400):
        parts = list(cut)
        for _ in range(draw.choice((1, 1, 2))):
            i, j = draw.randrange(len(parts)), draw.randrange(len(parts))
            how = draw.randrange(5)
            if how == 0:
                del parts[i]
            elif how == 1:
                parts.insert(i, parts[j])
            elif how == 2:
                parts[i], parts[j] = parts[j], parts[i]
            elif how == 3:
                parts[i] = re.sub(r"\d+", lambda m: draw.choice(("1", "06", "x", "479", "0")), parts[i], count=1)
            else:
                parts[i] = re.sub(r' (\w+)="', lambda m: draw.choice((f" {m[1]} = \"", f" X=' ID={m[1]}' {m[1]}=\"", f' FID="6" {m[1]}="', ' ID="1" ')), parts[i], count=1)
        rows.append((n, "".join(parts)))
    df = spark.createDataFrame(rows, "DocumentID int, xml string").repartition(8)
    for ignore in ((), ("unknown media",)):
        got = df.select("DocumentID", P.plain(F.col("xml"), not ignore).alias("plain"), P.first_error(F.col("xml"), ignore, proof=False).alias("slow"), P.first_error(F.col("xml"), ignore).alias("fast")).collect()
        assert [r.DocumentID for r in got if r.fast != r.slow or (r.plain and r.slow)] == []
        assert {-1, -2} <= {r.DocumentID for r in got if r.plain}
        right = sum(r.slow is None for r in got)
        assert sum(bool(r.plain) for r in got) > right / 2 > 20


def test_no_python_on_the_path(spark):
    plan = P.errors(spark.createDataFrame([(1, HEAD)], "DocumentID int, xml string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
