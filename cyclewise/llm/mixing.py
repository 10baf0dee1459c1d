"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight.  Complete epochs of a source come
first; what is left of its target goes to the documents in key order, by a prefix sum of sizes.  The gap behind
the prefix goes to the later documents that still fit, in key order, and one closing document takes what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import cut_lineage, range_ranked, text_of

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source supplies at most so many times its size.
MAX_EPOCHS = 3
#: Rows of a source that one window of the prefix sum takes on average.
BUCKET_ROWS = 4096
#: Parts into which documents of one source and size are dealt before they are ranked.
SALTS = 64

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1.25: 0.25 plus the share of letters among the characters (0 for empty texts)."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.lit(0.25) + F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def exponential_key(id_col: Column, weight: Column) -> Column:
    """-ln(u) / weight with u from the md5 of the id written as text: the same in every run."""
    bits = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / weight


def source_targets(spark: SparkSession, sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources``: (source, source_size), one row each -> the same with ``target``.

    Targets share the sum of all sizes by weight and stop at ``max_epochs`` times the size; the excess goes to
    the others by weight until none is above.  Each round is one small aggregate over the source table.
    """
    keyed = sources.select("source", "source_size", F.col("source").isNull().cast("int").alias("_last"))
    ranked, counts = range_ranked(keyed, ["_last", "source"], "mix-sources")
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((int(part), total))
        total += n
    off = spark.createDataFrame(offsets or [(0, 0)], "_part int, _off long")
    pos = F.row_number().over(Window.partitionBy("_part").orderBy("_last", "source")) - 1 + F.col("_off")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(pos, F.lit(len(weights))) + 1).cast("int"))
    src = cut_lineage(
        ranked.join(F.broadcast(off), "_part").withColumn("_w", weight)  # one row per partition
        .select("source", "source_size", "_w", (F.col("source_size") * max_epochs).alias("_cap")),
        "mix-weights",
    )
    whole = src.agg(F.sum("source_size")).first()[0] or 0
    # water level: sources whose cap lies at or under level * weight are full, the rest take level * weight
    level = 0.0
    while True:
        full = F.col("_cap") <= F.lit(level) * F.col("_w")
        rest, free = src.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("_w")))
        ).first()
        if not free:
            break
        new = (whole - (rest or 0)) / free
        if new <= level:
            break
        level = new
    full = F.col("_cap") <= F.lit(level) * F.col("_w")
    return src.select(
        "source", "source_size", F.when(full, F.col("_cap").cast("double")).otherwise(F.lit(level) * F.col("_w")).alias("target")
    )


def _closings(later: DataFrame) -> DataFrame:
    """Of each source the one later document that comes nearest to the gap, if it is nearer than none."""
    miss = F.abs(F.col("size") - F.col("_gap"))
    return later.filter(miss < F.col("_gap")).groupBy("_src").agg(
        F.min(F.struct(miss.alias("m"), F.col("key").alias("k"), F.col("doc_id").alias("d"), F.col("size").alias("s"), F.col("_until").alias("u"))).alias("_c")
    ).select(F.col("_src").alias("_cs"), F.col("_c.u").alias("_cu"))


def _refills(later: DataFrame) -> DataFrame:
    """The later documents that close the gap of each source: all that still fit, in key order, then the nearest one.

    Where the nearest one alone comes nearer, it is that one.  Of the documents of one size no more than fit into
    the gap, and one, can be taken; only these are gathered, so that a source's list depends on its longest
    document and not on its rows.
    """
    fits = F.col("_rank") <= F.floor(F.col("_gap") / F.col("size")) + 1
    near = later.filter(F.col("size") < 2 * F.col("_gap")).select("_src", "_gap", "size", "_until", F.pmod(F.xxhash64("_until"), F.lit(SALTS)).alias("_salt"))
    for keys in (["_src", "size", "_salt"], ["_src", "size"]):  # salted first: many documents may have one size
        near = near.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_until"))).filter(fits)
    listed = near.groupBy("_src").agg(F.max("_gap").alias("_gap"), F.array_sort(F.collect_list(F.struct(F.col("_until").alias("u"), F.col("size").alias("s")))).alias("_l"))

    def step(held, doc):
        taken = F.struct((held["rest"] - doc["s"]).alias("rest"), F.concat(held["got"], F.array(doc["u"])).alias("got"))
        return F.when(doc["s"] <= held["rest"], taken).otherwise(held)

    def nearest(gap, docs):
        some = F.filter(F.transform(docs, lambda d: F.struct(F.abs(d["s"] - gap).alias("m"), d["u"].alias("u"))), lambda d: d["m"] < gap)
        return F.array_min(some)

    start = F.struct(F.col("_gap").cast("double").alias("rest"), F.array().cast("array<bigint>").alias("got"))
    filled = listed.withColumn("_f", F.aggregate("_l", start, step)).withColumn("_one", nearest(F.col("_gap"), F.col("_l")))
    left = F.filter("_l", lambda d: (d["s"] < 2 * F.col("_f.rest")) & ~F.array_contains(F.col("_f.got"), d["u"]))
    filled = filled.withColumn("_last", nearest(F.col("_f.rest"), left))
    ends = F.coalesce(F.col("_last.m"), F.col("_f.rest"))
    many = F.concat(F.col("_f.got"), F.when(F.col("_last").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("_last.u")))
    picks = F.when(F.col("_one.m") < ends, F.array("_one.u")).otherwise(many)
    return filled.select(F.col("_src").alias("_cs"), F.explode(picks).alias("_cu"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS, refill: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, epochs, weight, key``.

    ``size`` is the number of words (null text: 0) and ``taken`` the words the mix takes from the document,
    repeats counted: a whole multiple of ``size``, at most ``max_epochs`` times.  Order in a source: key,
    then id, then size; a null id orders first.  Repeated rows are taken or left each for itself.  Empty texts and
    sources of size 0 take 0.  An empty table gives an empty result.  Without ``refill`` the gap behind the prefix
    gets the closing document only, which leaves up to half the longest document of the source.
    """
    spark = docs.sparkSession
    text = text_of(F.col(text_col))
    weight = quality_weight(text)
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"),
            weight.alias("weight"),
        ).withColumn("key", exponential_key(F.col("doc_id"), F.col("weight"))),
        "mix-rows",
    )
    # count and size of a source: map-side partial sums, so that a hot source is as cheap as any
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    targets = source_targets(spark, totals.select("source", "source_size"), weights, max_epochs)
    plan = targets.alias("t").join(totals.alias("n"), F.col("t.source").eqNullSafe(F.col("n.source"))).select(
        F.col("t.source").alias("_src"), F.col("t.source_size").alias("source_size"), "target",
        F.ceil(F.col("_docs") / F.lit(bucket_rows)).cast("long").alias("_buckets"),
    ).withColumn("_epochs", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long"))
    plan = cut_lineage(plan.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")), "mix-plan")
    # keys of weight w have distribution 1 - exp(-w key): cut at even shares of weight 1, in key order
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_src"))).withColumn(
        "_b", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("_buckets")).cast("long")
    )
    sums = placed.groupBy("_src", "_b").agg(F.sum("size").alias("_sum"))
    over = Window.partitionBy("_src").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("_src").alias("_s2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_src", "_b").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_in", F.sum("size").over(within)).join(
        starts, F.col("_src").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2"))
    ).withColumn("_until", F.col("_start") + F.col("_in"))
    summed = cut_lineage(
        summed.select("doc_id", "_src", "size", "weight", "key", "source_size", "target", "_epochs", "_rest", "_until"), "mix-sums"
    )
    # the gap that the prefix leaves, and the later documents that close it
    prefix = F.col("_until") <= F.col("_rest")
    gaps = summed.groupBy("_src").agg(F.max("_rest").alias("_r"), F.coalesce(F.max(F.when(prefix, F.col("_until"))), F.lit(0)).alias("_p"))
    gaps = gaps.select(F.col("_src").alias("_gs"), (F.col("_r") - F.col("_p")).alias("_gap"))
    later = summed.filter(~prefix & (F.col("size") > 0)).join(gaps, F.col("_src").eqNullSafe(F.col("_gs")))
    closing = (_refills if refill else _closings)(later)
    # without its empty texts, a source has each prefix sum once
    out = summed.join(closing, F.col("_src").eqNullSafe(F.col("_cs")) & (F.col("_until") == F.col("_cu")), "left")
    closes = F.col("_cu").isNotNull() & (F.col("size") > 0)
    epochs = F.col("_epochs") + F.when(prefix | closes, 1).otherwise(0)
    return out.withColumn("epochs", F.when(F.col("size") > 0, epochs).otherwise(F.lit(0)).cast("long")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs", "weight", "key"
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mixed table: every row of ``docs`` with its own columns, as often as the mix takes it.

    Rows that share an id and a size are taken alike.
    """
    own = docs.columns
    taken = mix(docs, id_col, source_col, text_col, **options).filter("epochs > 0")
    taken = taken.groupBy(F.col("doc_id").alias("_mid"), F.col("size").alias("_ms")).agg(F.max("epochs").alias("_me"))
    sized = docs.withColumn("_rs", word_count(text_of(F.col(text_col))))
    rows = sized.join(taken, F.col(id_col).eqNullSafe(F.col("_mid")) & (F.col("_rs") == F.col("_ms")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_me").cast("int")))).select(*[F.col(f"`{c}`") for c in own])
