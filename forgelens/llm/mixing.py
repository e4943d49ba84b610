"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only.

Targets: sources share ``share`` of all words by weight, none gets more than ``most`` times its
own words; what one can't take goes to the others by weight. That is one level L with target
min(most * size, L * weight), found from running sums over the sources.

Documents: a source takes each of its documents as often as its target holds it whole. For the
rest every document gets the key -ln(u) / quality, u a number in (0, 1] from a hash of its id;
documents are taken by rising key until the target is reached, the last one in part.

No source is sorted in one task. Keys fall into bins of equal ratio, so that a bin holds about
a tenth of a percent of a source at most, whatever the qualities. Sums per bin, combined before
the shuffle, tell for each source the bins below the target, and only the rows of the one bin
where it is reached are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelens.sources.staging import stage

WEIGHTS = (5, 2, 1)
_BINS = 256  # for each doubling of the key

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for a null one."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def plain_share(text: str = "text") -> Column:
    """Quality weight from 0.05 to 1: the share of a text's characters that are no symbols."""
    symbols = "#$%&*@^~|<>{}[]\\_=+"
    share = F.try_divide(F.length(F.translate(F.col(text), symbols, "")), F.length(text))
    return F.greatest(F.lit(0.05), F.coalesce(share, F.lit(1.0)))


def sampling_key(doc_id: str, quality: Column) -> Column:
    """Exponential key of a document: smaller means earlier. The same for the same id."""
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("double")
    return -F.ln((hashed + 1) / F.lit(float(1 << 48))) / quality


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.lit(list(weights)), F.col("place") % len(weights) + 1)
    ranked = sizes.withColumn("place", F.row_number().over(by_name).cast("int") - 1).withColumn("weight", weight).drop("place")
    # Sources reach their limit in the order of size by weight. Before each, what the earlier
    # ones took and the weight that is left give its level.
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, here_on = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    full = (
        ranked.withColumn("taken", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * most)
        .withColumn("left", F.sum("weight").over(here_on)).withColumn("whole", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("whole") * share - F.col("taken")) / F.col("left"))
        .withColumn("is_full", F.col("level") * F.col("weight") >= F.col("source_size") * most)
    )
    level = F.min(F.when(~F.col("is_full"), F.struct("taken", "level"))).over(everything)["level"]
    limit = F.col("source_size") * F.lit(most)
    target = F.when(F.col("is_full"), limit).otherwise(F.least(limit, F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    return full.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, quality: Column | None = None, carry: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, row) of every row of ``docs`` (doc_id, source, text).

    ``taken`` is the number of words that the mix takes of the row, repeats counted; a source's
    sum is its target, rounded to a word. Null texts have size 0 and are taken with 0 words.
    A null source is a source of its own, the last one. Rows repeated with one id share a key;
    ties go by size. ``row`` is a struct of the columns ``carry``, whatever their names. An empty
    table gives an empty result.
    """
    quality = plain_share() if quality is None else quality
    rows = stage(docs.select("doc_id", "source", word_count().alias("size"), sampling_key("doc_id", quality).alias("key"), F.struct(F.lit(None).cast("int").alias("none"), *carry).alias("row")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, share, most).withColumn("words", F.round("target").cast("long"))
    epochs = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    aims = stage(aims.withColumn("epochs", epochs.cast("long")).withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size")))

    bin_of = F.floor(F.log2(F.greatest("key", F.lit(1e-15))) * _BINS).cast("int")
    binned = rows.withColumn("bin", bin_of)
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    edges = sums.withColumn("upto", upto).withColumnRenamed("source", "__source")
    rests = aims.select(F.col("source").alias("__name"), "rest")
    edge = (
        edges.join(rests, F.col("__source").eqNullSafe(F.col("__name"))).where("upto > rest")
        .groupBy("__name").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("below"))).alias("edge"))
    )
    plan = stage(
        aims.join(edge, F.col("source").eqNullSafe(F.col("__name")), "left")
        .select(F.col("source").alias("__name"), "source_size", "target", "epochs", "rest", F.col("edge.bin").alias("edge"), "edge.below")
    )
    placed = binned.join(plan, F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
    decided = placed.where("edge is null or bin <> edge").withColumn("part", F.when(F.col("bin") < F.coalesce("edge", F.lit(1 << 30)), F.col("size")).otherwise(F.lit(0)))
    in_order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("below") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    at_edge = placed.where("bin = edge").withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before)))
    columns = ["doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), "row"]
    return decided.select(*columns).unionAll(at_edge.select(*columns))


def op6_mixing_sources(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of all documents."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


# The same in one statement. The level is found the same way, and the documents of a source by
# one running sum over its keys.
OP6_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    -ln((('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::bigint + 1)::double / 281474976710656.0)
      / greatest(0.05, coalesce(case when length(text) > 0 then length(translate(text, '#$%&*@^~|<>{}[]\_=+', ''))::double / length(text) end, 1.0)) as key
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s),
f as (
  select *, 2.0::double * coalesce(sum(source_size) over (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as taken_before,
    sum(weight) over (order by source_size::double / weight, source nulls last rows between current row and unbounded following)::double as left_weight,
    sum(source_size) over ()::double as whole from w),
g as (select *, (whole * 1.5::double - taken_before) / left_weight as level from f),
h as (select *, level * weight >= source_size * 2.0::double as is_full from g),
l as (select coalesce(arg_min(level, taken_before) filter (where not is_full), 0.0) as level from h),
t as (
  select source, source_size, (case when is_full then source_size * 2.0::double else least(source_size * 2.0::double, l.level * weight) end)::double as target
  from h, l),
a as (select *, round(target)::bigint as words, case when source_size > 0 then round(target)::bigint // source_size else 0 end as epochs from t),
r as (
  select d.doc_id, d.size, a.source_size, a.target, a.epochs, a.words - a.epochs * a.source_size as rest,
    coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as before
  from d join a on d.source is not distinct from a.source)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken from r
"""
