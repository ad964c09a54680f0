"""Document fingerprints by consistent weighted sampling, in DataFrame
functions only.

A document is its words (hashes) weighted by how often they occur. For sample s
and word t, hashes of (t, s) give r and c, both Gamma(2, 1), and beta, uniform.
A word of weight w has q = floor(ln w / r + beta) and ln a = ln c - r (q - beta)
- r; the sample is the (t, q) of least a. Two documents agree in a sample with
probability equal to their generalised Jaccard similarity (sum of the lesser
over sum of the greater weights), so ``likeness`` of two fingerprints, the
share of samples in which they agree, estimates it with a standard deviation of
at most 0.5 / sqrt(samples).

The three are made of four exponentials: c = e3 + e4, e1 = -ln(e3 / c), r = e1 +
e2, beta = e2 / r. The ratio of two exponentials to their sum is uniform and
independent of the sum, so r, c and beta are independent and distributed as
above, and a = e3 exp(-r q). Ordered by 1 - exp(-a), a word of weight 1, which
has q = 0, needs a hash and nothing else.

Words are sorted and counted within a row; one (word, weight) row each then
meets one minimum per sample. A row's words are in its block's task, so nothing
is shuffled but the texts, once, by block; a text's fingerprint is compared with
the next one's there too.

Defined results: rows go by descending doc_id, null ids last, those of one id by a
hash of their text (equal ones in any order); a null text is an empty one; a text without words has the
fingerprint ``''``, which is like another such (1) and like no other (0). Equal
texts have equal fingerprints. Repeated rows each have one. Extra columns are
ignored. An empty table gives no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded, cut

#: At a similarity of 0.8 the standard deviation is 0.035.
SAMPLES = 128
#: Samples of one aggregate; wider ones leave Spark's generated code, narrower ones cost
#: more rows than they save (8 at once: 2590 CPU seconds a GB on the cluster, 32: 1970).
SAMPLES_AT_ONCE = 32
#: Bits of a hash of a sample's (word, q) that a fingerprint keeps.
ID_BITS = 24
ROWS_PER_BLOCK = 500

_WORDS = (r"if(btrim({0}, ' \t\n\u000b\u000c\r') = '', array(), "
          r"split(btrim({0}, ' \t\n\u000b\u000c\r'), '[\\x20\\x09-\\x0D]+'))")


def _sample(s: int) -> Column:
    """1 - exp(-a) (39 bits) and bits of t, of a row's word: the least number is
    the one of least a, and equal numbers are equal (t, q)."""
    h = f"(xxhash64(t, first_sample + {s}) & 9223372036854775807L)"
    g = f"xxhash64(t, first_sample + {s}, 1)"
    v = f"((shiftright({h}, {ID_BITS}) + 0.5D) * 1.8189894035458565E-12D)"
    u4 = f"((shiftrightunsigned({g}, 32) + 0.5D) * 2.3283064365386963E-10D)"
    u2 = f"((({g} & 4294967295L) + 0.5D) * 2.3283064365386963E-10D)"
    r = f"(-ln({u2} / (1D + ln({u4}) / log1p(-{v}))))"
    # r q = x - x mod r with x = ln w + e2
    ln_share = f"(log1p(-{v}) * {u2} / w * exp((ln_w - ln({u2})) % {r}))"
    # q = 0 where (1 - v) ^ (w - 1) > u4
    return F.expr(f"case when w is null then null when w = 1D or {u4} < 1D - (w - 1D) * {v} "
                  f"then {h} else shiftleft(cast(-expm1({ln_share}) * 549755813888D as bigint), "
                  f"{ID_BITS}) | ({h} & {(1 << ID_BITS) - 1}L) end")


def fingerprints(df: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys and fingerprint of each row of ``df``; keys tell its rows apart."""
    rows = df.select(*keys, F.expr(f"sort_array(transform({_WORDS.format('text')}, "
                                   "w -> xxhash64(w)))").alias("hashes"))
    # positions where a new word begins
    rows = rows.withColumn("begins", F.expr(
        "filter(if(size(hashes) = 0, cast(array() as array<int>), sequence(0, size(hashes) - 1)), "
        "i -> i = 0 or get(hashes, i) <> get(hashes, i - 1))"))
    terms = ("transform(begins, (b, j) -> struct(get(hashes, b) as t, "
             "cast(coalesce(get(begins, j + 1), size(hashes)) - b as double) as w))")
    at_once = min(samples, SAMPLES_AT_ONCE)
    each = (rows.select(*keys, F.expr(terms).alias("terms"))
            .select("*", F.explode(F.array(*map(F.lit, range(0, samples, at_once))))
                    .alias("first_sample"))
            .select(*keys, "first_sample", F.expr("inline_outer(terms)"))
            .select(*keys, "first_sample", "t", "w", F.ln("w").alias("ln_w")))
    least = each.groupBy(*keys, "first_sample").agg(
        *(F.min(_sample(s)).alias(f"m{s}") for s in range(at_once)))
    part = [F.lpad(F.lower(F.hex(F.xxhash64(f"m{s}").bitwiseAND((1 << ID_BITS) - 1))),
                   ID_BITS // 4, "0") for s in range(at_once)]
    parts = least.select(*keys, F.struct("first_sample", F.when(F.col("m0").isNull(), "").otherwise(
        F.concat(*part)).alias("ids")).alias("part"))
    return parts.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        *keys, F.substring(F.array_join("parts.ids", ""), 1, samples * (ID_BITS // 4))
        .alias("fingerprint"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree."""
    n = ID_BITS // 4
    return F.expr(
        f"case when {a} = {b} then 1D when {a} = '' or {b} = '' then 0D else size(filter("
        f"sequence(0, {samples - 1}), i -> substring({a}, i * {n} + 1, {n}) = "
        f"substring({b}, i * {n} + 1, {n}))) / {samples}D end")


#: The order of the rows: descending doc_id, null last, a hash of the text, then the row.
ORDER = ["z", "o", "k1", "k2", "tie"]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, k1, k2 (hash of the text) and next_text of the following
    row in descending order of doc_id; the first follows the last."""
    return in_blocks(docs).where(~F.col("halo")).drop("halo", "block")


def _key() -> Column:
    return F.struct(*ORDER)


def _cuts(docs: DataFrame, blocks: int) -> DataFrame:
    """The first keys of all blocks but the first (key, j from 1): one small row
    each, from a range partitioning of the keys alone."""
    first = cut(docs.select(*ORDER).repartitionByRange(blocks, *ORDER)
                .groupBy(F.spark_partition_id().alias("p")).agg(F.min(_key()).alias("key")), "cuts")
    w = Window.orderBy("key")
    return first.select("key", (F.row_number().over(w) - 1).alias("j")).where("j > 0")


def blocked(docs: DataFrame) -> DataFrame:
    """Adds ``block``: runs of neighbours in the whole order, so that many rows of one
    doc_id, or of none, are many blocks too. A row is compared with the square root
    of the number of blocks twice: first with every so many-th cut, then with those
    between, which a join brings."""
    n = docs.count()
    blocks = math.ceil(n / ROWS_PER_BLOCK)
    if blocks < 2:
        return docs.withColumn("block", F.lit(0))
    cuts = cut(_cuts(docs, blocks), "numbered-cuts")
    step = max(1, math.isqrt(cuts.count()))
    cuts = cuts.withColumn("part", F.expr(f"int((j - 1) div {step})"))
    coarse = [r["key"] for r in cuts.where(F.col("j") % step == 1 % step).orderBy("j").collect()]
    fine = cut(cuts.groupBy("part").agg(F.sort_array(F.collect_list("key")).alias("keys")), "fine-cuts")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    heads = F.array(*(F.struct(*(F.lit(k[c]).cast(kinds[c]).alias(c) for c in ORDER))
                      for k in coarse))
    key = _key()
    part = docs.withColumn("part", F.size(F.filter(heads, lambda c: c <= key)) - 1)
    return part.join(bounded(fine, len(coarse) * step), "part", "left").withColumn(
        "block", F.when(F.col("part") < 0, 0).otherwise(
            F.col("part") * step + F.size(F.filter("keys", lambda c: c <= key)))).drop("part", "keys")


def in_blocks(docs: DataFrame) -> DataFrame:
    """The rows of ``with_next``, dealt to blocks of neighbours, so that no task
    sorts all, and in order within a block. As its last a block also has the first
    row of the one behind it (halo)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({
        "z": F.col("doc_id").isNull(), "o": F.bitwise_not("doc_id"), "k1": F.xxhash64("text"),
        "k2": F.xxhash64("text", F.lit(1)), "tie": F.xxhash64(F.monotonically_increasing_id())})
    docs = blocked(docs)
    # the first row of each block (its key alone), and which block is behind it
    first = cut(docs.groupBy("block").agg(F.min(_key()).alias("f")).select("block", "f.*"), "first")
    ahead = Window.orderBy("block")  # one row for each block, no text
    whole = ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = first.select("block", F.coalesce(F.lead("block").over(ahead), F.first("block").over(whole))
                          .alias("behind"))
    same = ((F.col("block") == F.col("b")) & F.col("o").eqNullSafe(F.col("ho"))
            & (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")))
    heads = docs.join(bounded(first.select(
        F.col("block").alias("b"), F.col("o").alias("ho"), F.col("k1").alias("h1"),
        F.col("k2").alias("h2")), first.count()), same).select(
        F.col("block").alias("behind"), "text", *ORDER).dropDuplicates(["behind"])
    halo = heads.join(before, "behind").drop("behind")
    both = docs.withColumn("halo", F.lit(False)).unionByName(
        halo.withColumns({"halo": F.lit(True), "doc_id": F.lit(None).cast("bigint")}))
    w = Window.partitionBy("block").orderBy("halo", *ORDER)
    return both.select("block", "doc_id", "text", "k1", "k2", "halo",
                       F.lead("text").over(w).alias("next_text"))


def edited(text: str = "text", following: str = "next_text") -> Column:
    """The text, its last half replaced by the next one's beginning."""
    half = f"cast(floor(length({text}) / 2) as int)"
    return F.expr(f"concat(substring({text}, 1, length({text}) - {half}), "
                  f"substring({following}, 1, {half}))")


def document_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """The digest: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next of every row."""
    own = F.struct(F.lit(False).alias("is_edit"), F.col("text"))
    edit = F.struct(F.lit(True).alias("is_edit"), F.col("edit").alias("text"))
    rows = (in_blocks(docs).withColumn("edit", edited())
            .withColumn("row", F.monotonically_increasing_id())  # in order within a block
            .select("block", "row", "halo", "doc_id",
                    F.length("text").cast("bigint").alias("n_chars"),
                    F.sha2("edit", 256).alias("edited_sha256"),
                    F.explode(F.when(F.col("halo"), F.array(own))
                              .otherwise(F.array(own, edit))).alias("v"))
            .select("*", "v.*").drop("v"))
    keys = [c for c in rows.columns if c != "text"]
    # a text is followed by its edit, and that by the next text
    w = Window.partitionBy("block").orderBy("row", "is_edit")
    return (fingerprints(rows, keys, samples)
            .withColumns({"edited_fingerprint": F.lead("fingerprint", 1).over(w),
                          "next_fingerprint": F.lead("fingerprint", 2).over(w)})
            .where("not is_edit and not halo")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"),
                    likeness("fingerprint", "next_fingerprint", samples).alias("near_next")))
