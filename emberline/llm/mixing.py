"""Mixing sources to target weights: exact block quotas split down a tree of output shards. Built-in functions only.

Each source is cut into permuted blocks by a hash of its documents. Its target is met by whole passes over the
source plus, for the rest, its blocks in permuted order; one block at the edge gives single documents. Every block
draw is a unit. The units of all sources are split in halves down a binary tree by a random order of each node, so
the count of a source on one side follows the multivariate hypergeometric law, and the counts at the leaves are
exact quotas. A shard draws as many of the source's permuted blocks as its quota says, disjoint from all others'.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.llm.quality import word_list
from emberline.session import stage


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order, null last. A target stops at `cap` times its source.

    A source has at most `cells` blocks (a power of two), about `per_block` documents or more in each. `rounds`
    bounds the refinement at the edge, not what is drawn. `spread` is the number of places that the copies of one
    document are dealt to where some of them are chosen.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    cap: int = 3
    cells: int = 1024
    per_block: int = 256
    depth: int = 4
    rounds: int = 4
    spread: int = 4096
    seed: int = 20240131


def _keyed(docs: DataFrame, mix: Mix) -> DataFrame:
    """`docs` with the source key, the document's place in the permutation, its cell and its size.

    A place is a hash of doc_id and text, so the rows of one place are copies.
    """
    place = F.xxhash64(F.lit(mix.seed), "doc_id", "text")
    return docs.withColumns(
        {
            "_key": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")),
            "_place": place,
            "_cell": F.pmod(place, F.lit(mix.cells)).cast("int"),
            "_size": F.size(word_list(F.coalesce(F.col("text"), F.lit("")))).cast("long"),
        }
    )


def targets(cells: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per source: _key, source_size, n_docs, target, passes (whole passes over the source) and rest (words).

    Shares rise together, weight by weight, until a source reaches its cap. The common level is the greatest that
    any set of the first capped sources (by cap over weight) would leave to the others.
    """
    sources = cells.groupBy("_key").agg(
        F.min("_source").alias("_source"), F.sum("words").alias("source_size"), F.sum("n").alias("n_docs")
    )
    nth = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    rows = sources.withColumn("weight", F.get(weights, F.pmod(nth, F.lit(len(mix.weights)))))
    most = mix.cap * F.col("source_size").cast("double")
    first = W.orderBy(most / F.col("weight"), "_key").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    size, weight = F.col("source_size").cast("double"), F.col("weight")
    left = F.sum(size).over(everything) - F.coalesce(F.sum(mix.cap * size).over(first), F.lit(0.0))
    open_weight = F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(first), F.lit(0.0))
    rows = rows.withColumn("_level", left / open_weight)
    rows = rows.withColumn("_level", F.max("_level").over(everything))
    rows = rows.withColumn("target", F.least(most, F.col("_level") * weight))
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    blocks = F.expr(f"cast(pow(2, floor(log2(greatest(1, least({mix.cells}, n_docs / {mix.per_block}))))) AS int)")
    return rows.select(
        "_key", "source_size", "n_docs", "target", passes.alias("passes"),
        (F.col("target") - passes * size).alias("rest"), blocks.alias("blocks"),
    )


def _edge(docs: DataFrame, blocks: DataFrame, mix: Mix) -> DataFrame:
    """Per source with a block that is drawn in part: steps (array of after, upto, gap) and some (array of place, copies,
    many).

    Places go in order while all their copies fit; of the first one that does not fit as many copies are taken as do,
    which `some` tells. From there on only documents that fit the gap are looked at. At last the one document nearest
    the gap is taken, if that is nearer than none: no source misses its target by more than half a document.
    """
    at = blocks.filter("_edge").select("_key", "_cell", "_gap")
    rows = docs.join(at, ["_key", "_cell"]).groupBy("_key", "_place", "_gap").agg(F.min("_size").alias("_size"), F.count("*").alias("_copies"))
    rows = stage(rows, "mix-edge")
    some = "array<struct<place:bigint,copies:bigint,many:bigint>>"
    state = rows.groupBy("_key").agg(
        F.min("_gap").alias("gap"), F.lit(-(1 << 63)).cast("long").alias("after"),
        F.expr("cast(array() AS array<struct<after:bigint,upto:bigint,gap:double>>)").alias("steps"),
        F.expr(f"cast(array() AS {some})").alias("some"),
    )
    order = W.partitionBy("_key").orderBy("_place")
    for _ in range(mix.rounds):
        fit = rows.join(state.select("_key", "gap", "after"), "_key")
        fit = fit.filter((F.col("_place") > F.col("after")) & (F.col("_size") <= F.col("gap")))
        fit = fit.withColumn("_sum", F.sum(F.col("_size") * F.col("_copies")).over(order))
        whole = F.col("_sum") <= F.col("gap")
        got = fit.groupBy("_key").agg(
            F.max(F.when(whole, F.col("_place"))).alias("upto"), F.coalesce(F.max(F.when(whole, F.col("_sum"))), F.lit(0)).alias("_got"),
            F.min_by(F.struct("_place", "_size", "_copies"), F.when(~whole, F.col("_place"))).alias("_next"),
        )
        state = state.join(got, "_key", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
        state = state.withColumn("_many", F.coalesce(F.floor((F.col("gap") - F.col("_got")) / F.col("_next._size")), F.lit(0)))
        step = F.array(F.struct("after", "upto", "gap"))
        part = F.array(F.struct(F.col("_next._place").alias("place"), F.col("_next._copies").alias("copies"), F.col("_many").alias("many")))
        state = state.select(
            "_key",
            (F.col("gap") - F.col("_got") - F.col("_many") * F.coalesce("_next._size", F.lit(0))).alias("gap"),
            F.coalesce("_next._place", "upto", "after").alias("after"),
            F.when(F.col("upto").isNull(), F.col("steps")).otherwise(F.concat("steps", step)).alias("steps"),
            F.when(F.col("_many") > 0, F.concat("some", part)).otherwise(F.col("some")).alias("some"),
        )
    state = stage(state, "mix-steps")
    taken = F.coalesce(_some(F.col("_place")), F.lit(0))
    rest = rows.join(state, "_key").filter(~_stepped(F.col("_place"), F.col("_size")) & (taken < F.col("_copies")))
    off = F.abs(F.col("_size") - F.col("gap"))
    pick = rest.filter(off < F.col("gap")).groupBy("_key").agg(
        F.min_by(F.struct(F.col("_place").alias("place"), F.col("_copies").alias("copies"), (taken + 1).cast("long").alias("many")), F.struct(off, "_place")).alias("pick")
    )
    # The picked place replaces its own entry, if it has one.
    every = F.expr("concat(filter(some, x -> pick IS NULL OR x.place != pick.place), filter(array(pick), x -> x IS NOT NULL))")
    return state.join(pick, "_key", "left").select("_key", "steps", every.alias("some"))


def _stepped(place: Column, size: Column) -> Column:
    return F.exists("steps", lambda s: (place > s["after"]) & (place <= s["upto"]) & (size <= s["gap"]))


def _some(place: Column) -> Column:
    """How many copies of the place are taken, where that is neither none nor all; null elsewhere."""
    return F.get(F.filter("some", lambda s: s["place"] == place), F.lit(0))["many"]


def _chosen(rows: DataFrame, mix: Mix) -> DataFrame:
    """Of the copies of each place the `_many` rows that are drawn once more (`_last`), whichever they are.

    A place may hold any number of copies: they are dealt to `spread` parts, each of which chooses its share.
    """
    rows = stage(rows.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(mix.spread))), "mix-copies")
    counts = rows.groupBy("_key", "_place", "_part").agg(F.count("*").alias("_here"), F.first("_many").alias("_all"))
    before = F.sum("_here").over(W.partitionBy("_key", "_place").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    quota = counts.select("_key", "_place", "_part", (F.col("_all") - F.coalesce(before, F.lit(0))).alias("_quota"))
    nth = F.row_number().over(W.partitionBy("_key", "_place", "_part").orderBy(F.lit(1)))
    return rows.join(quota, ["_key", "_place", "_part"]).withColumn("_last", nth <= F.col("_quota")).drop("_quota", "_part")


def _shards(units: DataFrame, mix: Mix) -> DataFrame:
    """Units (_key, _unit) with their shard: every node of the tree halves its units in a random order."""
    rows = units.withColumn("_node", F.lit(0))
    for level in range(mix.depth):
        node = W.partitionBy("_node")
        nth = F.row_number().over(node.orderBy(F.xxhash64(F.lit(mix.seed + level + 1), "_key", "_unit"), "_key", "_unit"))
        rows = rows.withColumn("_right", (2 * nth > F.count("*").over(node) + 1).cast("int"))
        rows = rows.select("_key", "_unit", (2 * F.col("_node") + F.col("_right")).alias("_node"))
    return rows


def _plan(keyed: DataFrame, mix: Mix) -> DataFrame:
    """`_keyed` rows with size, source_size, target and draws; the other columns stay. `keyed` is read three times: its
    narrow columns twice, and all of it once."""
    narrow = keyed.select("source", "_key", "_cell", "_place", "_size")
    cells = stage(
        narrow.groupBy("_key", "_cell").agg(
            F.min("source").alias("_source"), F.sum("_size").alias("words"), F.count("*").alias("n")
        ),
        "mix-cells",
    )
    wanted = stage(targets(cells, mix), "mix-targets")
    blocks = (
        cells.drop("_source", "n").join(wanted, "_key")
        .groupBy("_key", F.pmod("_cell", "blocks").alias("_block"))
        .agg(F.sum("words").alias("words"), F.first("rest").alias("rest"), F.first("passes").alias("passes"))
    )
    permuted = W.partitionBy("_key").orderBy(F.xxhash64(F.lit(mix.seed), "_key", "_block"), "_block")
    before = F.coalesce(F.sum("words").over(permuted.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    gap = F.col("rest") - before
    blocks = blocks.withColumns(
        {"_gap": gap, "_whole": (F.col("rest") > 0) & (gap >= F.col("words")), "_edge": (gap > 0) & (gap < F.col("words"))}
    )
    blocks = blocks.withColumn("_draws", F.col("passes") + (F.col("_whole") | F.col("_edge")).cast("int"))
    drawn = blocks.select(
        "_key", "_block", F.explode(F.expr("CASE WHEN _draws > 0 THEN sequence(0, _draws - 1) ELSE array() END")).alias("_copy")
    )
    drawn = drawn.withColumn(
        "_nth",
        F.row_number().over(W.partitionBy("_key").orderBy("_copy", F.xxhash64(F.lit(mix.seed), "_key", "_block"), "_block")),
    )
    quotas = _shards(drawn.select("_key", F.col("_nth").alias("_unit")), mix)
    # The units that a shard holds of a source, in shard order, are that source's permuted draws in turn.
    quotas = quotas.withColumn("_nth", F.row_number().over(W.partitionBy("_key").orderBy("_node", "_unit")))
    where = drawn.join(quotas.select("_key", "_nth", "_node"), ["_key", "_nth"]).groupBy("_key", "_block").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_copy").alias("copy"), F.col("_node").alias("shard")))).alias("_drawn")
    )
    blocks = stage(blocks.join(where, ["_key", "_block"], "left"), "mix-blocks")
    by_cell = cells.select("_key", "_cell").join(wanted, "_key").withColumn("_block", F.pmod("_cell", "blocks"))
    by_cell = by_cell.join(blocks.select("_key", "_block", "_edge", "_gap", "_drawn"), ["_key", "_block"])
    edge = _edge(narrow.drop("source"), by_cell, mix)
    by_cell = stage(by_cell.join(edge, "_key", "left"), "mix-plan").select(
        "_key", "_cell", "source_size", "target", "_edge", "_drawn", "steps", "some"
    )
    rows = keyed.join(by_cell, ["_key", "_cell"])
    # The last draw of the block at the edge holds for its chosen documents only.
    all_of = ~F.col("_edge") | F.coalesce(_stepped(F.col("_place"), F.col("_size")), F.lit(False))
    rows = rows.withColumns({"_last": all_of, "_many": F.when(~all_of, F.coalesce(_some(F.col("_place")), F.lit(0))).cast("long")})
    rows = rows.withColumn("_copies", F.get(F.filter("some", lambda s: s["place"] == F.col("_place")), F.lit(0))["copies"])
    plain = rows.filter("_many IS NULL OR _many = 0 OR _many = _copies").withColumn("_last", F.col("_last") | (F.coalesce("_many", F.lit(0)) > 0))
    parted = by_cell.filter(F.exists("some", lambda s: s["many"] < s["copies"]))
    if not parted.isEmpty():
        plain = plain.unionByName(_chosen(rows.filter("_many > 0 AND _many < _copies"), mix))
    none = F.expr("cast(array() AS array<struct<copy:int,shard:int>>)")
    draws = F.when(F.col("_last"), F.col("_drawn")).otherwise(F.expr("slice(_drawn, 1, size(_drawn) - 1)"))
    kept = [c for c in keyed.columns if c not in ("_key", "_place", "_cell", "_size")]
    return plain.select(*kept, F.col("_size").alias("size"), "source_size", "target", F.coalesce(draws, none).alias("draws"))


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """`docs` with size, source_size, target, and draws: array of (shard, copy), one entry for each time it is taken.

    Null and empty texts have size 0; they follow their block. Null sources are one source, the last. Repeated rows
    are documents each: where not all of them are taken once more, it is open which. An empty table gives an empty
    result. Input columns that have the name of a result are replaced.
    """
    return _plan(_keyed(docs.drop("size", "source_size", "target", "draws"), mix), mix)


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, and shards: where each of its draws goes. Texts are read once."""
    rows = stage(_keyed(docs.select("doc_id", "text", "source"), mix).drop("text"), "mix-rows")
    plan = _plan(rows, mix)
    shards = F.array_join(F.transform("draws", lambda d: d["shard"].cast("string")), ",")
    taken = F.col("size") * F.size("draws")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"), shards.alias("shards"))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: a row of `docs` for each draw, with copy, shard and place (the order within the shard)."""
    rows = mix_plan(docs.drop("copy", "shard", "place"), mix)
    rows = rows.withColumn("_draw", F.explode("draws")).select(*rows.columns, "_draw.*").drop("draws")
    return rows.withColumn("place", F.xxhash64(F.lit(mix.seed), "shard", "copy", "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))))
