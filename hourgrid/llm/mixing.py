"""Mixing sources to target weights by hash-threshold histograms.

Every document has a draw, a 52-bit hash of its id. A source takes each of its
documents ``floor(target / source_size)`` times and, for the rest of its budget,
once more those whose draw is below a threshold. The threshold is found without
sorting: sizes are summed by (source, bucket of the draw), the bucket in which
the budget ends is cut into buckets again, and so on until the draw's last bit.
Only the boundary bucket is refined. Rows that share the draw in which the budget
ends (one id with several contents, null ids) are refined in the same way by a hash
of their content, so they are not taken or left as one block. Larger budgets only
add documents (nested).

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and
share all words by weight; a target stops at 3 times its source's size and the
excess is shared again by weight until none is above.

The document in which a budget ends is taken if that is nearer to the budget.

Defined results: null texts have size 0 and take 0 words; a null source is a
source of its own; a null id draws as an id of its own. Equal rows (id, source,
size; in ``mixed_documents`` all columns) get draws of their own by a copy number,
so a row that is repeated very often is still split. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import WORD, Hot, attach, hot_keys, key_text, mark_possible, md5_int, quoted, read
from hourgrid.session import materialize

WEIGHTS, MOST = (5.0, 2.0, 1.0), 3
DRAW_BITS, STEP_BITS = 52, 13
#: Copies of a row are numbered in blocks of so many.
COPY_BLOCK = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, copy: Column) -> Column:
    return md5_int(F.concat(F.lit("mix/"), key_text(doc_id), F.lit("/"), copy.cast("string")))


def tie_break(*content: Column) -> Column:
    """The order of rows with the same draw: as many bits as a draw, of a hash of the content."""
    return F.shiftrightunsigned(F.xxhash64(*content), 64 - DRAW_BITS)


def each_copy(groups: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every group ``_n`` times, with ``_copy`` from 1 to ``_n``."""
    last = F.floor((F.col("_n") - 1) / COPY_BLOCK).cast("long")
    blocks = groups.select(*columns, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_block"))
    first = F.col("_block") * COPY_BLOCK
    return blocks.select(*columns, F.explode(F.sequence(first + 1, F.least(F.col("_n"), first + COPY_BLOCK))).alias("_copy"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size) with the target of each source.

    The shares end where the sources with the smallest size per weight are held at
    ``most`` times their size and the level ``rest / weight left`` fits all others.
    The table has one row per source.
    """
    # ranks are taken over the table of sources, which is as small as their number
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", ((F.row_number().over(by_name) - 1) % len(weights)).alias("_i"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("_i"))
    ranked = ranked.select("source", "source_size", weight.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    order = [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = ranked.select("source", "source_size", "w", "cap", (rest / left).alias("level"))
    fits = F.when(F.col("cap") >= F.col("level") * F.col("w"), F.col("level"))
    # the first level that fits is the smallest: a level only rises while sources are held
    final = level.select("source", "source_size", "w", "cap",
                         F.first(fits, ignorenulls=True).over(
                             Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
                             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("level"))
    return final.select("source", "source_size",
                        F.least(F.col("cap"), F.coalesce("level", F.lit(0.0)) * F.col("w")).alias("target"))


def _descend(rows: DataFrame, state: DataFrame, bits: int, step_bits: int, hot: Hot) -> DataFrame:
    """``state`` (sid, full, budget, prefix) with the draw in which each budget ends as prefix, the budget left
    before it, and the size (edge_size) and rows (edge_rows) of that draw."""
    while bits > 0:
        step = min(step_bits, bits)
        low = bits - step
        inside = F.shiftright("draw", bits) == F.col("prefix")
        bucket = F.shiftright("draw", low).alias("bucket")
        held = attach(rows, state, ["sid"], hot)
        sums = held.where(inside).groupBy("sid", "budget", bucket).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = sums.select("sid", "budget", "bucket", "s", "n", F.sum("s").over(upto).alias("cum"))
        edge = (cum.where(F.col("cum") > F.col("budget")).groupBy("sid")
                .agg(F.min(F.struct("bucket", (F.col("cum") - F.col("s")).alias("before"), "s", "n")).alias("e")))
        nxt = state.join(edge, "sid", "left").select(
            "sid", "full",
            F.when(F.col("e").isNotNull(), F.col("budget") - F.col("e.before")).otherwise(F.col("budget")).alias("budget"),
            # no boundary (all fits): a prefix beyond every draw takes all that is left
            F.when(F.col("e").isNotNull(), F.col("e.bucket")).otherwise(F.shiftleft(F.col("prefix") + 1, step) ).alias("prefix"),
            F.col("e.s").alias("edge_size"), F.col("e.n").alias("edge_rows"))
        state = materialize(nxt, "mix-level")
        bits = low
    return state


def thresholds(rows: DataFrame, plan: DataFrame, draw_bits: int = DRAW_BITS, step_bits: int = STEP_BITS, hot: Hot | None = None) -> DataFrame:
    """(sid, full, limit, tie_limit): copies of every document, and the draw below which one more is taken;
    of the rows whose draw is the limit, those with a tie below ``tie_limit``.

    ``rows`` has (sid, size, draw, and tie if draws may be shared) and is read once a level; ``plan`` has (sid,
    source_size, target). Histograms have at most 2**step_bits rows per source.
    """
    hot = hot or hot_keys(rows.groupBy("sid").agg(F.count(F.lit(1)).alias("_rows")), ["sid"], "_rows")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = plan.select("sid", full.alias("full"),
                        (F.col("target") - full * F.col("source_size")).alias("budget"),
                        F.lit(0).cast("long").alias("prefix"))
    state = _descend(rows, materialize(state, "mix-level"), draw_bits, step_bits, hot)
    # the last bucket is one draw (of one row, or one tie): take it when that is nearer to the budget
    limit = F.col("prefix") + F.coalesce(2 * F.col("budget") >= F.col("edge_size"), F.lit(False)).cast("long")
    shared = F.coalesce(F.col("edge_rows") > 1, F.lit(False))
    whole = state.select("sid", "full", limit.alias("limit"), F.lit(0).cast("long").alias("tie_limit"))
    if "tie" not in rows.columns or state.where(shared).isEmpty():
        return whole
    edges = state.where(shared)
    own = attach(rows, edges.select("sid", F.col("prefix").alias("_edge")), ["sid"], hot)
    own = materialize(own.where(F.col("draw") == F.col("_edge")).select("sid", "size", F.col("tie").alias("draw")), "mix-ties")
    ties = _descend(own, materialize(edges.select("sid", "full", "budget", F.lit(0).cast("long").alias("prefix")), "mix-level"), DRAW_BITS, step_bits, hot)
    ties = edges.select("sid", "full", F.col("prefix").alias("limit")).join(ties.select("sid", limit.alias("tie_limit")), "sid")
    return whole.join(edges, "sid", "left_anti").unionByName(ties)


def _planned(rows: DataFrame) -> tuple[DataFrame, Hot]:
    """Per source its target, copies and threshold; ``rows`` (source, size, draw, tie) is a stored table. Also the sources with most rows."""
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")), "mix-sizes")
    hot = hot_keys(sizes.withColumn("sid", source_key(F.col("source"))), ["sid"], "_rows")
    plan = targets(sizes).withColumn("sid", source_key(F.col("source")))
    plan = materialize(plan, "mix-targets")
    limits = thresholds(rows.select(source_key(F.col("source")).alias("sid"), "size", "draw", "tie"),
                        plan.select("sid", "source_size", "target"), hot=hot)
    return materialize(plan.join(limits, "sid"), "mix-plan"), hot


def source_key(source: Column) -> Column:
    """A join key that keeps the null source apart from every text."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def copies(full: Column, limit: Column, tie_limit: Column, draw_: Column, tie: Column) -> Column:
    return full + ((draw_ < limit) | ((draw_ == limit) & (tie < tie_limit))).cast("long")


def _copies() -> Column:
    return copies(F.col("full"), F.col("limit"), F.col("tie_limit"), F.col("draw"), F.col("tie"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words), copies, source."""
    sized = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"))
    groups = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_n"))
    rows = each_copy(groups, ["doc_id", "source", "size"])
    # rows of a source with the same draw have the same id and differ in size
    rows = materialize(rows.select("doc_id", "source", "size", draw(F.col("doc_id"), F.col("_copy")).alias("draw"),
                                   tie_break(F.col("doc_id"), F.col("size")).alias("tie")), "mix-rows")
    plan, hot = _planned(rows)
    placed = attach(rows.withColumn("sid", source_key(F.col("source"))),
                    plan.select("sid", "source_size", "target", "full", "limit", "tie_limit"), ["sid"], hot)
    times = _copies()
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"),
                         times.alias("copies"), "source")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken (0 to 3 times).

    Rows equal in all columns are numbered as in ``mix``; rows of one id and source that differ are told apart by a 64-bit hash
    of all columns. Columns may have any name and type.
    """
    names = docs.columns
    # maps have neither a hash nor an order: their text stands for them
    whole = [F.col(quoted(f.name)).cast("string") if "map<" in f.dataType.simpleString() else F.col(quoted(f.name)) for f in docs.schema.fields]
    keyed = docs.select(F.struct("*").alias("_row"), F.col(quoted(id_col)).alias("_id"), F.col(quoted(source_col)).alias("_source"),
                        word_count(F.col(quoted(text_col))).alias("_size"), F.xxhash64(*whole).alias("_hash"))
    keys = ["_id", "_source", "_hash"]
    groups = materialize(keyed.groupBy(*keys, "_size").agg(F.count(F.lit(1)).alias("_n")), "mix-groups")
    draws = [draw(F.col("_id"), F.col("_copy")).alias("draw"), tie_break(F.col("_hash")).alias("tie")]
    rows = each_copy(groups, [*keys, "_size"])
    plan, hot = _planned(materialize(rows.select(F.col("_source").alias("source"), F.col("_size").alias("size"), *draws), "mix-rows"))
    # rows that may be repeated are exchanged, counted before that; the others stay where they are
    again = groups.where(F.col("_n") > 1)
    marked = mark_possible(keyed.select("_row", *keys), F.col("_hash"), again, F.col("_hash"), "_maybe")
    equal = marked.where("_maybe").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first("_row").alias("_row"))
    single = marked.where("NOT _maybe").select("_row", *keys, F.lit(1).cast("long").alias("_copy"))
    keyed = single.unionByName(each_copy(equal, ["_row", *keys]))
    placed = attach(keyed.select("_row", source_key(F.col("_source")).alias("sid"), *draws),
                    plan.select("sid", "full", "limit", "tie_limit"), ["sid"], hot)
    times = _copies().cast("int")
    taken = placed.select("_row", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))).alias("_time"))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in names])


def op9_mix_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix(read(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")
