"""Preference formatting: shared prompt and paired, masked completions.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import dense_id


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, t array<struct<turn, role, text>>)`` in turn order, ties by role and text.

    A conversation is one training example, so its turns must fit one row.  Rows without a conversation id belong to
    none and are left out; a null role or text counts as empty; repeated rows stay.
    """
    part = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("t"))


def common_turns(a: str, b: str) -> Column:
    """How many leading turns are equal in role and text."""
    same = f"zip_with({a}, {b}, (x, y) -> x IS NOT NULL AND y IS NOT NULL AND x.role <=> y.role AND x.text <=> y.text)"
    return F.expr(f"coalesce(nullif(array_position({same}, false), 0) - 1, size({same}))").cast("int")


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))), "")


def mask(turns: str) -> Column:
    """``start:end`` of what the assistant says, its end mark too, in the rendered turns: code points, comma-joined."""
    head, size = "length(t.role) + 5", "length(t.role) + 5 + length(t.text) + 8"
    step = f"named_struct('at', a.at + {size}, 'm', if(t.role = 'assistant', concat(a.m, array(concat(a.at + {head}, ':', a.at + {size}))), a.m))"
    return F.expr(f"aggregate({turns}, named_struct('at', 0, 'm', cast(array() as array<string>)), (a, t) -> {step}, a -> array_join(a.m, ','))")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs(pair_id, chosen, rejected)``, both arrays of turns -> prompt, completions and loss masks.

    The prompt is the longest common prefix of turns, rendered once.  Equal conversations are all prompt, with empty
    completions; empty or null arrays count as no turns, null turns, roles and texts as empty ones; the mask of a
    completion without assistant turns is empty; null and repeated ids stay, other columns are ignored, no rows give none.
    """
    none = F.expr("cast(array() as array<struct<turn: bigint, role: string, text: string>>)")
    whole = lambda x: F.expr(f"transform({x}, t -> named_struct('turn', t.turn, 'role', coalesce(t.role, ''), 'text', coalesce(t.text, '')))")
    p = pairs.select("pair_id", F.coalesce(whole("chosen"), none).alias("c"), F.coalesce(whole("rejected"), none).alias("r"))
    p = p.withColumn("n", common_turns("c", "r"))
    rest = lambda x: F.slice(x, F.col("n") + 1, F.size(x))
    p = p.select("pair_id", "n", F.slice("c", 1, F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return p.select("pair_id", F.col("n").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"), mask("c").alias("chosen_mask"), mask("r").alias("rejected_mask"))


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: rejected is the conversation itself with its last assistant turn
    answered by the last assistant turn of the next conversation that has one, by id; the last is followed by the first.

    Conversations without an assistant turn make no pair, nor does the only one that has any.
    """
    conv = conversations(turns)
    conv = conv.withColumn("at", F.expr("size(t) - array_position(reverse(transform(t, x -> x.role)), 'assistant') + 1")).filter("exists(t, x -> x.role = 'assistant')")
    last = turns.filter("conv_id IS NOT NULL AND role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct(F.col("turn"), F.coalesce("text", F.lit("")).alias("text"))).alias("other"))
    placed = dense_id(last, ["conv_id"], "place")
    n = placed.count()
    follow = placed.select("conv_id", ((F.col("place") + 1) % max(n, 1)).alias("k")).join(placed.select(F.col("place").alias("k"), "other"), "k")
    both = conv.join(follow.select(F.col("conv_id").alias("c"), "other").filter(F.lit(n > 1)), F.col("conv_id") == F.col("c"))
    swapped = F.expr("transform(t, (x, i) -> if(i + 1 = at, named_struct('turn', x.turn, 'role', x.role, 'text', other.text), x))")
    return both.select(F.col("conv_id").alias("pair_id"), F.col("t").alias("chosen"), swapped.alias("rejected"))


#: The query in DuckDB SQL.
ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, max(pos) AS ap FROM t WHERE role = 'assistant' GROUP BY 1),
o AS (SELECT a.conv_id, t.text AS other, row_number() OVER (ORDER BY a.conv_id) - 1 AS place, count(*) OVER () AS n FROM a JOIN t ON t.conv_id = a.conv_id AND t.pos = a.ap),
l AS (SELECT x.conv_id, y.other FROM o x JOIN o y ON y.place = (x.place + 1) % x.n WHERE x.n > 1),
p AS (SELECT t.*, CASE WHEN pos = ap THEN other ELSE text END AS rtext,
             '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS cr,
             '<|' || role || '|>' || chr(10) || CASE WHEN pos = ap THEN other ELSE text END || '<|end|>' || chr(10) AS rr
      FROM t JOIN a USING (conv_id) JOIN l USING (conv_id)),
n AS (SELECT conv_id, coalesce(min(CASE WHEN text <> rtext THEN pos END) - 1, max(pos)) AS n FROM p GROUP BY 1),
q AS (SELECT p.*, n.n, sum(CASE WHEN pos > n THEN length(cr) ELSE 0 END) OVER w AS ce, sum(CASE WHEN pos > n THEN length(rr) ELSE 0 END) OVER w AS re
      FROM p JOIN n USING (conv_id) WINDOW w AS (PARTITION BY conv_id ORDER BY pos))
SELECT conv_id AS pair_id, CAST(max(n) AS INTEGER) AS n_prompt_turns,
  coalesce(string_agg(cr, '' ORDER BY pos) FILTER (WHERE pos <= n), '') AS prompt,
  coalesce(string_agg(cr, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS chosen,
  coalesce(string_agg(rr, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS rejected,
  coalesce(string_agg(CAST(CAST(ce - length(cr) + length(role) + 5 AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(ce AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos > n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(CAST(re - length(rr) + length(role) + 5 AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(re AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos > n AND role = 'assistant'), '') AS rejected_mask
FROM q GROUP BY conv_id
"""
