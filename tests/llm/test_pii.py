import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The patterns as they are stated."""
    out = []
    for kind, (name, rx) in enumerate(PLAIN.items()):
        for m in re.finditer(rx, text):
            digits = re.sub("[^0-9]", "", m[0])
            if name == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if name == "card":
                odd = [int(c) for c in digits[::-1]]
                if not 13 <= len(digits) <= 19 or (sum(odd[::2]) + sum(sum(divmod(2 * c, 10)) for c in odd[1::2])) % 10:
                    continue
            if name == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TEXTS = st.text(alphabet="ab@.-_+%0123456789 ()é\n", max_size=60) | st.lists(st.sampled_from(["4111 1111 1111 1111", "a@b.co", "1.2.3.4", "+1 (743) 555-3824", "256.1.1.1", ".", "@", "-", "x", " ", "é", "00", "_a@c-d.ef", "4111-1111-1111-1112"]), max_size=9).map("".join)


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_are_linear():
    assert pii.base_spans("1" * 300_000) == [] and pii.base_spans("a" * 300_000 + " 1." * 100_000) == []
    assert len(pii.base_spans("x@y.zz " * 20_000)) == 20_000


ROWS = [(1, "mail a@b.com or 10.0.0.1", "x"), (2, None, "x"), (3, "", "x"), (None, "card 4111 1111 1111 1111", "x"), (1, "mail a@b.com or 10.0.0.1", "x"), (5, "call me on (743) 555-3824 or write ann at mail dot com", "x"), (6, "né +49 (30) 1234567" * 2000, "x")]


def test_query(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string, spans string")
    got = pii.op1_personal_data(d).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = next(t for i, t, _ in ROWS if i == r.doc_id) or ""
        base = plain(text)
        digest = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert set(filter(None, digest.split(","))) <= set(r.spans.split(","))
    assert pii.op1_personal_data(d.limit(0)).count() == 0


def test_method_adds_and_clean_texts_stay_clean(spark):
    good = [(i, f"phone (743) 555-{1000 + i} please") for i in range(40)] + [(100 + i, f"order 000 000 {1000 + i}x") for i in range(40)] + [(200 + i, "nothing here at all, at noon") for i in range(40)]
    d = spark.createDataFrame(good, "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in pii.op1_personal_data(d).collect()}
    assert all(got[i] == 1 for i in range(40)) and all(got[i] == 0 for i in [*range(100, 140), *range(200, 240)])


def test_redaction_keeps_columns_and_nulls(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string, _text string")
    out = pii.redact(d, pii.fit(pii.propose(d)))
    assert out.columns == d.columns
    rows = out.collect()
    assert sum(r.text is None for r in rows) == 1
    assert "mail [EMAIL] or [IP]" in {r.text for r in rows}
    assert not any(pii.base_spans(r.text or "") for r in rows)


def test_many_spans_are_quick_and_disjoint():
    text = "call (743) 555-1234 now\n" * 20_000
    began = time.time()
    found = pii.loose_spans(text, pii.base_spans(text))
    assert len(found) == 20_000 and time.time() - began < 10
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))


def test_spelt_out_addresses_in_capitals_are_proposed(spark):
    assert [c[:4] for c in pii.candidates("write to Jane AT Example DOT Com")] == [(0, 9, 32, False)]


def test_boundary_looks_at_both_sides():
    assert pii.votes("10.1.2.3x", 1, 0, 8, True)[1] == -1 and pii.votes("10.1.2.3", 1, 0, 8, True)[1] == 1 and pii.votes("a10.1.2.3 ", 1, 1, 9, True)[1] == -1


def test_classifier_tells_words_apart_that_no_labeler_knows(spark):
    """Spans with equal votes but other surroundings get other probabilities once the labelled ones around them differ."""
    rows = [(i, f"phone ring (743) 555-{1000 + i}") for i in range(200)] + [(1000 + i, f"order part (000) 000-{1000 + i}") for i in range(200)]
    model = pii.fit(pii.propose(spark.createDataFrame(rows, "doc_id long, text string")))
    p = lambda t: float((pii.design([pii.candidates(t)[0][4]], [pii.candidates(t)[0][5]]) @ model.weights[3])[0])
    assert p("ring (743) 555-9999") > p("part (743) 555-9999")


def test_em_finds_the_unreliable_labeler():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.5
    acc = [0.95, 0.9, 0.9, 0.85, 0.8, 0.5]
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) for a in acc], 1) * 2 - 1
    pattern, inverse, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, like = pii.expectation_maximisation(pattern, count.astype(float))
    assert ((post[inverse.reshape(-1)] > 0.5) == truth).mean() > 0.95
    assert abs(like[1, 5, 2] - 0.5) < 0.05 and like[1, 0, 2] > 0.9
