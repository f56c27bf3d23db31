"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check.

DataFrame functions only.  Windows start at every word; those are fingerprinted that hold as many shingles of items as the
similarity needs at least, whatever their order.  That count bounds the similarity from above, so nothing is lost by it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

#: 64 bits in six blocks: within radius 23 some block differs in at most three bits (23 < 6 * 4).
BLOCKS, RADIUS, FLIPS = 6, 23, 3
#: A pair of windows at similarity 0.8 differs in 10 bits on average (standard deviation 3): the radius is four deviations off.
SHINGLE, SIMILARITY = 5, 0.8
#: Rows of the item shingle table up to which it is broadcast (about 40 MB); beyond, a shuffle join does the same.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(hashes: Column, k: int) -> Column:
    """A hash for each run of ``k`` word hashes; none where there are fewer."""
    n = F.size(hashes) - k
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(*[hashes[i + j] for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of longs; two 32-bit counters share a long, so an array may have 2^31 entries."""
    counts = f"aggregate({hashes}, array_repeat(0L, 32), (acc, h) -> transform(acc, (a, i) -> a + (shiftrightunsigned(h, i) & 4294967297L)))"
    bit = "if((a & 4294967295L) * 2 > size({h}), shiftleft(1L, i), 0L) | if(shiftrightunsigned(a, 32) * 2 > size({h}), shiftleft(1L, i + 32), 0L)".format(h=hashes)
    return F.expr(f"aggregate(transform({counts}, (a, i) -> {bit}), 0L, (x, y) -> x | y)")


def _blocks() -> list[list[int]]:
    """For each block: its mask and the XOR masks of up to ``FLIPS`` of its bits, as signed longs."""
    cuts = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [[signed((1 << b) - (1 << a))] + [signed(sum(1 << i for i in c)) for n in range(FLIPS + 1) for c in combinations(range(a, b), n)] for a, b in zip(cuts, cuts[1:])]


def _items(benchmark: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """``(item_id, n, sh, fp)`` of the items whose shingles have ``k`` words: five, or all of a shorter item."""
    it = benchmark.select(F.col(id_col).alias("item_id"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("wh")).distinct()
    n = F.size("wh")
    it = it.filter(n >= k if k == SHINGLE else n == k).select("item_id", n.alias("n"), shingles(F.col("wh"), k).alias("sh"))
    return it.withColumn("fp", simhash("sh"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, start, n_words, similarity)``: the most similar window of each document for each item.

    Similarity is the weighted Jaccard measure of five-word shingles with their counts as weights, and at least 0.8;
    ties go to the earlier window.  A window has as many words as the item; a document with fewer is one window.  Items of
    fewer than five words match as a whole.  Texts that are null or have no word match nothing; rows that share an id,
    null ids too, count as one document or item whose best match is given; other columns are ignored.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("d"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("wh"))
    size = benchmark.select(F.least(F.size(words(F.col(item_text))), F.lit(SHINGLE)).alias("k")).filter("k > 0")
    found = None
    for k in sorted(r["k"] for r in size.distinct().collect()):  # at most five values
        got = _matches(src, written(_items(benchmark, item_id, item_text, k), f"items-{k}"), k)
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], "d bigint, item_id bigint, start int, n int, similarity double")
    best = found.groupBy("d", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n")).alias("b"))
    return best.select(F.col("d").alias(doc_id), "item_id", (-F.col("b.s")).alias("start"), F.col("b.n").alias("n_words"), F.col("b.similarity").alias("similarity"))


def _starts(k: int) -> Column:
    """Starts of the windows of ``width`` words that hold enough of the sorted shingle places ``p``.

    Similarity s of a window with m shingles and an item with i takes s / (1 + s) * (m + i) common ones.  The windows
    whose first place is ``p[j]`` start after ``p[j - 1]``, so no start comes twice.
    """
    need = f"cast(ceil({SIMILARITY / (1 + SIMILARITY)!r}D * (width - {k} + 1 + n - {k} + 1) - 1e-9) as int)"
    low = f"greatest(0, p[j + {need} - 1] - width + {k}, if(j > 0, p[greatest(j - 1, 0)] + 1, 0))"
    high = "least(p[j], size - width)"
    each = f"transform(sequence(0, size(p) - {need}), j -> if({low} <= {high}, sequence({low}, {high}), cast(array() as array<int>)))"
    return F.expr(f"if(size(p) >= {need}, flatten({each}), cast(array() as array<int>))")


def _matches(src: DataFrame, items: DataFrame, k: int) -> DataFrame:
    known = items.select("n", F.explode("sh").alias("h")).distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    src = src.withColumn("r", F.xxhash64("wh"))
    hits = src.select("d", "r", F.size("wh").alias("size"), F.posexplode(shingles(F.col("wh"), k)).alias("p", "h")).join(known, "h")
    places = hits.groupBy("d", "r", "size", "n").agg(F.sort_array(F.collect_set("p")).alias("p"))
    places = places.withColumn("width", F.least("size", "n")).withColumn("w", _starts(k)).filter("size(w) > 0")
    places = places.groupBy("d", "r").agg(F.flatten(F.collect_list(F.expr("transform(w, s -> named_struct('start', s, 'width', width, 'n', n))"))).alias("w"))
    places = written(places.select(F.col("d").alias("e"), F.col("r").alias("f"), "w"), "windows")
    at = src.join(places, F.col("d").eqNullSafe(F.col("e")) & (F.col("r") == F.col("f"))).select("d", shingles(F.col("wh"), k).alias("all"), "w")
    at = at.select("d", "all", F.explode("w").alias("w"))
    at = at.select("d", F.col("w.start").alias("start"), F.col("w.n").alias("n"), F.slice("all", F.col("w.start") + 1, F.col("w.width") - k + 1).alias("ws"))
    at = written(at.withColumns({"fp": simhash("ws"), "u": F.xxhash64("ws")}), "prints")

    # Fingerprints meet without their windows, each once, however many windows have it.
    blocks = _blocks()
    near = items.select("item_id", "n", F.col("fp").alias("ifp"), F.explode(F.array(*[F.struct(F.lit(i).alias("b"), F.lit(m[0]).alias("m"), F.array(*map(F.lit, m[1:])).alias("x")) for i, m in enumerate(blocks)])).alias("s"))
    near = near.select("item_id", "n", "ifp", F.col("s.b").alias("b"), F.explode(F.transform("s.x", lambda x: F.col("ifp").bitwiseAND(F.col("s.m")).bitwiseXOR(x))).alias("key"))
    probes = at.select("n", "fp").distinct().select("*", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m[0])) for m in blocks])).alias("b", "key"))
    close = probes.join(near, ["n", "b", "key"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS).select("n", "fp", "item_id").distinct()

    # Windows of the same words are compared once.
    texts = at.join(close.select("n", "fp").distinct(), ["n", "fp"], "left_semi").groupBy("n", "fp", "u").agg(F.first("ws").alias("ws")).join(close, ["n", "fp"])
    one = texts.select("n", "item_id", "u", F.size("ws").alias("mw"), F.explode("ws").alias("h")).groupBy("n", "item_id", "u", "mw", "h").agg(F.count("*").alias("cw"))
    ref = items.select("item_id", F.size("sh").alias("mi"), F.xxhash64("sh").alias("v"), F.explode("sh").alias("h")).groupBy("item_id", "v", "mi", "h").agg(F.count("*").alias("ci"))
    both = one.join(ref.withColumnRenamed("item_id", "j"), F.col("item_id").eqNullSafe(F.col("j")) & (one["h"] == ref["h"]))
    both = both.groupBy("n", "item_id", "u", "v", "mw", "mi").agg(F.sum(F.least("cw", "ci")).alias("common"))
    sim = both.select("n", "item_id", "u", (F.col("common") / (F.col("mw") + F.col("mi") - F.col("common"))).alias("similarity"))
    sim = written(sim.groupBy("n", "item_id", "u").agg(F.max("similarity").alias("similarity")).filter(F.col("similarity") >= SIMILARITY), "similar")
    return at.select("d", "start", "n", "u").join(sim, ["n", "u"]).select("d", "item_id", "start", "n", "similarity")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows that share an id go or stay together."""
    bad = written(contamination(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
