"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import table
from tallyport.session import small_side

# A rate is split into parts of at most PART; TERMS terms of the distribution leave out less than 1e-17.
PART, TERMS = 16, 80
SEED = 7


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 sum."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _distribution(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable with this mean."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def step(acc, k):
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["c"])


def mixed(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    epochs: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Every document as many times as its Poisson count says, in global random order.

    A source's mass is the UTF-8 bytes of its texts plus one for each row. Its rate is chosen
    so that the expected mass of the output is `epochs` times that of the input, shared out
    by `weights` (a source that is not named has weight 0; without weights all sources have
    the same). Counts are the inverse of the Poisson distribution at a number hashed from
    seed and id, so the same document always gets the same count; rates above 16 are sums of
    parts with numbers of their own. The output has the columns of `docs` with copy (from 1),
    copies and shuffle_key, replacing columns of these names. It is dealt to partitions by a hash of
    shuffle_key and ordered by it within them.

    A null source is a source of its own, named by the key None. Repeated rows have the same
    count. A null or empty text has mass 1. An empty table gives an empty result.
    """
    docs = docs.drop("copy", "copies", "shuffle_key")
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1
    masses = docs.groupBy(F.col(source_col).alias("__source")).agg(F.sum(size).alias("__mass"))
    if weights is None:
        masses = masses.withColumn("__weight", F.lit(1.0))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, w double")
        masses = masses.join(F.broadcast(named), F.col("__source").cast("string").eqNullSafe(F.col("s")), "left").select(
            "__source", "__mass", F.coalesce("w", F.lit(0.0)).alias("__weight")
        )
    whole = masses.agg(F.sum("__mass").alias("__all"), F.sum("__weight").alias("__weights"))  # one row
    share = F.col("__weight") / F.col("__weights")
    rate = share * (F.lit(float(epochs)) * F.col("__all")) / F.col("__mass")
    rates = (
        masses.join(F.broadcast(whole), F.lit(True))
        .withColumn("__rate", F.coalesce(rate, F.lit(0.0)))
        .withColumn("__parts", F.greatest(F.ceil(F.col("__rate") / PART), F.lit(1)).cast("int"))
        .withColumn("__below", _distribution(F.col("__rate") / F.col("__parts")))
        .select("__source", "__parts", "__below")
    )
    numbers = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda j: uniform(F.lit(seed), F.col(id_col), j))
    count = F.aggregate(
        numbers, F.lit(0), lambda acc, u: acc + F.size(F.filter(F.col("__below"), lambda c: c <= u))
    )
    # a row for each source; broadcast if it is measured to be small, so that documents move once, at the end
    counted = docs.join(small_side(rates), F.col(source_col).eqNullSafe(F.col("__source"))).withColumn("copies", count)
    copies = counted.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("order"), F.col("copy")))
    out = copies.withColumn("shuffle_key", key).select(*docs.columns, "copy", "copies", "shuffle_key")
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


MIXED_SQL = """
    with sized as (select *, coalesce(strlen(text), 0) + 1 as size from {docs}),
    masses as (select source as s, sum(size)::double as mass from sized group by source),
    rates as (
        select s, (1.0::double / count(*) over ()) * sum(mass) over () / mass as rate, greatest(ceil(rate / 16), 1)::int as parts,
            [list_sum([exp(-(rate / parts) + j * ln(rate / parts) - lgamma(j + 1)) for j in range(k + 1)]) for k in range(81)] as below
        from masses
    ), counted as (
        select sized.*, list_sum([len(list_filter(below, lambda c: c <=
            (('0x' || substr(md5('7|' || coalesce(doc_id::varchar, 'null') || '|' || j), 1, 13))::bigint + 0.5) / 4503599627370496))
            for j in range(1, parts + 1)])::int as copies
        from sized join rates on source is not distinct from s
    ), copied as (select *, unnest(range(1, copies + 1))::int as copy from counted)
"""


@query(
    "op10_mixing",
    MIXED_SQL.format(docs="documents")
    + "select doc_id, source, copy, copies, md5('7|' || coalesce(doc_id::varchar, 'null') || '|order|' || copy) as shuffle_key from copied",
)
def op10_mixing(spark, sf_dir):
    """Every document replicated so that all sources weigh the same, in random order."""
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "copy", "copies", "shuffle_key")
