"""One row per key, and the merge of the two post sources.

`row_number() = 1` is planned with a rank limit on the map side, so each task ships at most one row per key
and a key that holds a large part of all rows does not pile up in one task.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.config import Settings
from emberline.functions.moments import AsOf, hours_before
from emberline.functions.text import clean_text
from emberline.operators.normalise import HOT, fill_hot_text, harmonise_hot, mark_stream
from emberline.schemas import quoted
from emberline.session import stage

# `rest` stands for a hash of all other columns: rows that agree in the named ones still have one order.
LATEST_FETCH = ("fetch_timestamp desc", "score desc", "num_comments desc", "rest desc")
BEST_SCORE = ("score desc", "processed_ts desc", "data_source asc", "num_comments desc", "rest desc")


def rest_hash(columns: Sequence[str], named: Sequence[str]) -> Column:
    """Hash of the columns that an order does not name; of a box of columns if there is one."""
    others = [c for c in columns if c not in named]
    return F.xxhash64(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)


def ordering(keys: Sequence[str], columns: Sequence[str] = ()) -> list[Column]:
    """`"name desc"` / `"name asc"` to sort columns; nulls come last going down and first going up."""
    named = [k.split()[0] for k in keys]
    found = [rest_hash(columns, named) if name == "rest" else F.col(name) for name in named]
    return [c.desc() if k.endswith(" desc") else c.asc() for k, c in zip(keys, found, strict=True)]


def first_n(
    df: DataFrame, n: int, group: Sequence[str], order: Sequence[str], made: dict[str, Column] | None = None
) -> DataFrame:
    """The first `n` rows of each group. `made` are further columns of a row, made ahead of the exchange: a long column
    that only they and the order read does not cross it.
    """
    place = F.row_number().over(W.partitionBy(*group).orderBy(*ordering(order, df.columns)))
    rows = df.withColumns(made) if made else df
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def dedup(df: DataFrame, key: str = "id", order: Sequence[str] = BEST_SCORE) -> DataFrame:
    return first_n(df, 1, [key], order)


# So many keys are sent to every task at most: some 50 MB.
FEW_KEYS = 1_000_000


def first_n_in_place(df: DataFrame, n: int, key: str, order: Sequence[str], few: int = FEW_KEYS) -> DataFrame:
    """`first_n` for keys that seldom hold more than `n` rows: only the rows of those that do cross an exchange.

    They are counted first, which reads the key alone; if there are more than `few`, all rows are ranked as `first_n`
    does. `df` is read up to three times: it must give the same rows each time.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    over = stage(counts.filter(F.col("_n") > n).select("_key"), "over")
    found = over.count()
    if found > few:
        return first_n(df, n, [key], order)
    if not found:
        return df
    among = F.broadcast(over), F.col(key).eqNullSafe(F.col("_key"))
    return df.join(*among, "left_anti").unionByName(first_n(df.join(*among, "left_semi"), n, [key], order))


PLACE = ("_file", "_row")


def placed(stored: DataFrame) -> DataFrame:
    """A written Parquet table as it was read, with the place of each row: its file and its number there."""
    return stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _bit(nth: Callable[[Column], Column]) -> Column:
    return nth(F.col("_row") + 1)  # the functions count the bits of a bitmap from 1


def mark_places(chosen: DataFrame) -> DataFrame:
    """Bitmaps of the places in `chosen`, one bit a stored row, as a written table."""
    marked = chosen.groupBy("_file", _bit(F.bitmap_bucket_number).alias("_bucket"))
    return stage(marked.agg(F.bitmap_construct_agg(_bit(F.bitmap_bit_position)).alias("_bits")), "chosen")


def at_places(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The `placed` rows that `mark_places` marked, read where they lie: the bitmaps alone are sent, to every task."""
    bit = _bit(F.bitmap_bit_position)
    byte = F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1
    found = rows.withColumn("_bucket", _bit(F.bitmap_bucket_number)).join(F.broadcast(marked), ["_file", "_bucket"])
    return found.filter(is_set).select(*rows.columns)


def chosen_in_place(stored: DataFrame, columns: Sequence[str], choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of a written Parquet table that `choose` keeps, read where they lie: no wide row crosses an exchange.

    `choose` gets `columns` and the place of each row, which it has to hand on, and may group and join as it likes.
    """
    rows = placed(stored)
    return at_places(rows, mark_places(choose(rows.select(*columns, *PLACE)))).select(*stored.columns)


FETCH_ORDER = ("source_pos asc", "listing_pos asc")


def first_seen(df: DataFrame, in_place: bool = False) -> DataFrame:
    """The copy of each id that came first in fetch order. `in_place` suits stored rows, most of whose ids come once."""
    return first_n_in_place(df, 1, "id", FETCH_ORDER) if in_place else dedup(df, "id", FETCH_ORDER)


def top_n_listing(
    df: DataFrame,
    n: int = Settings.listing_limit,
    group: str = "listing",
    order: str = "listing_pos",
    in_place: bool = False,
) -> DataFrame:
    """What a listing request returns: its first `n` rows, pinned ones included.

    `in_place` suits stored rows of listings that are mostly no longer than `n`.
    """
    ranked = [f"{order} asc"]
    return first_n_in_place(df, n, group, ranked) if in_place else first_n(df, n, [group], ranked)


def drop_stickied(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("stickied"), F.lit(False)))


def _rest(columns: Sequence[str], keep: Sequence[str]) -> str:
    return f"struct({', '.join(quoted(c for c in columns if c not in keep))})"


def _unboxed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    plain = df.columns
    return df.selectExpr(*[f"`{c}`" if c in plain else f"_rest.`{c}` as `{c}`" for c in columns])


def _since(df: DataFrame, ts: str, since: Column) -> DataFrame:
    recent = df.filter(F.col(ts) >= since)
    if "processing_date" in df.columns:  # the day of the time: a bound that drops no row but prunes folders
        recent = recent.filter(F.col("processing_date") >= F.to_date(since))
    return recent


def box_history(df: DataFrame, ts: str, since: Column, keep: Sequence[str]) -> DataFrame:
    """All rows, with `keep` as columns and the rest as one struct, which is null for rows older than `since`.

    Old rows can outrank a recent copy, so they must take part in a dedup, but their texts are never
    needed. Each half is its own scan: the recent one prunes row groups, the old one reads `keep` only,
    and a shuffled old row holds `keep` and one null.
    """
    rest = _rest(df.columns, keep)
    recent = _since(df, ts, since).selectExpr(*keep, f"{rest} as _rest")
    old = df.filter((F.col(ts) < since) | F.col(ts).isNull())
    return recent.unionByName(old.selectExpr(*keep, "null as _rest"))


def latest_hot(bronze: DataFrame, **made: Column) -> DataFrame:
    """The last fetched copy of each hot post across all batches, and the columns `made` of it under names of their own."""
    taken = sorted(made.keys() & set(bronze.columns))
    if taken:
        raise ValueError(f"the order reads {taken} as they are: other names are asked for")
    return first_n(bronze, 1, ["id"], LATEST_FETCH, made)


# What the merge compares of a copy; the rest of it travels as one box.
_COMPARED = ("score", "processed_ts", "num_comments", "data_source")


def _hashed(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c not in ("_rest", "_key", "_own", *PLACE)]
    return df.withColumn("_hash", rest_hash(names, ["id", *_COMPARED, "fetch_timestamp"]))


def _copies(df: DataFrame, fetched: Column, rest: Column) -> DataFrame:
    rows = df if "_hash" in df.columns else _hashed(df)
    return rows.select("id", *_COMPARED, fetched.alias("_fetched"), "_hash", rest.alias("_rest"))


def _best_copies(stream: DataFrame, hot: DataFrame, columns: Sequence[str], lent: Sequence[str] = ()) -> DataFrame:
    """One row an id from `_copies` of both sources: the last fetched hot copy against the best stream copy, by score.

    Both winners are found in one aggregation, so a row crosses one exchange, and a task sends two copies of an id at
    most, however many it holds. At equal score and time the hot copy wins, as its source comes first. A hot copy whose
    box says `_own` false takes the columns `lent` from the stream copy.
    """
    is_hot = F.col("data_source") == HOT
    copy = F.struct(*_COMPARED, "_rest")
    # A null order takes no part, so each side sees its own source only.
    last = F.when(is_hot, F.struct("_fetched", "score", "num_comments", "_hash"))
    best = F.when(~is_hot, F.struct("score", "processed_ts", "num_comments", "_hash"))
    won = stream.unionByName(hot).groupBy("id").agg(F.max_by(copy, last).alias("hot"), F.max_by(copy, best).alias("stream"))
    rank = lambda side: F.struct(F.col(f"{side}.score"), F.col(f"{side}.processed_ts"))
    hot_wins = F.col("stream").isNull() | (F.col("hot").isNotNull() & (rank("hot") >= rank("stream")))
    loans = [F.col(f"stream._rest.{c}").alias(f"_lent_{c}") for c in lent]
    rows = won.select("id", F.when(hot_wins, F.col("hot")).otherwise(F.col("stream")).alias("_won"), *loans)
    found = rows.select("id", "_won.*", *[f"_lent_{c}" for c in lent])
    if not lent:
        return _unboxed(found, columns)
    own = F.col("_rest._own")
    texts = [F.when(own, F.col(f"_rest.{c}")).otherwise(F.col(f"_lent_{c}")).alias(f"_text_{c}") for c in lent]
    named = {c: f"`{c}`" if c in found.columns else f"_rest.`{c}`" for c in columns} | {c: f"_text_{c}" for c in lent}
    return found.select("*", *texts).selectExpr(*[f"{value} as `{c}`" for c, value in named.items()])


_TEXTS = ("title", "selftext")
_LONG = ("selftext", "text_combined")


def texts_apart(stream: DataFrame, hot: DataFrame) -> DataFrame:
    """Ids (`_key`) with a hot copy whose texts are not those of all its other copies, or that has no stream copy.

    Texts of one id are compared by a hash of 64 bits; it and the id are all that is moved.
    """
    marks = [F.col(c) for c in _TEXTS] + [F.col(c).isNull() for c in _TEXTS]
    copies = [df.select("id", F.lit(n).alias("hot"), F.xxhash64(*marks).alias("text")) for n, df in enumerate((stream, hot))]
    seen = copies[0].unionByName(copies[1]).groupBy(F.col("id").alias("_key")).agg(
        F.min("hot").alias("least"), F.max("hot").alias("most"), (F.min("text") != F.max("text")).alias("differ")
    )
    return stage(seen.filter("most = 1 AND (least = 1 OR differ)").select("_key"), "apart")


def merge_sources(
    silver: DataFrame,
    bronze: DataFrame,
    cfg: Settings = Settings(),
    few: int = FEW_KEYS,
    columns: Sequence[str] | None = None,
    made: dict[str, Column] | None = None,
) -> DataFrame:
    """All posts of both sources, the best-scored copy of each id.

    `columns` names those asked for, `made` gives some of them another value, from the columns of the post. If no long
    text is among them as it is, they are made of every copy ahead of the exchange and no long text crosses it.

    Else a hot copy that has the texts of its stream copy leaves them behind, and so does a stream copy with its cleaned
    text where that can be made again behind the shuffle. The ids whose texts differ are found first; hot copies of these
    alone carry theirs, or all of them if there are more than `few` such ids.
    """
    hot = harmonise_hot(bronze, cfg, False, "fetch_timestamp")
    stream = mark_stream(silver)
    asked, made = list(stream.columns if columns is None else columns), made or {}
    taken = sorted(made.keys() & {"id", *_COMPARED})
    if taken:
        raise ValueError(f"the order reads {taken} as they are: other names are asked for")
    asked += [c for c in made if c not in asked]
    if not any(c in asked and c not in made for c in _LONG):
        boxed = {c: made.get(c, F.col(f"`{c}`")) for c in asked if c not in ("id", *_COMPARED)}
        rest = F.struct(*[value.alias(c) for c, value in boxed.items()] or [F.lit(None).alias("_none")])
        # The hash that decides between equal copies is that of the rows before they are filled.
        rows = _hashed(stream), fill_hot_text(_hashed(hot))
        pair = _copies(rows[0], F.lit(None).cast("string"), rest), _copies(rows[1], F.col("fetch_timestamp"), rest)
        return _best_copies(*pair, asked)
    return _merged_whole(stream, hot, few).withColumns(made).select(*quoted(asked))


def _merged_whole(stream: DataFrame, hot: DataFrame, few: int) -> DataFrame:
    names = [c for c in stream.columns if c not in ("id", *_COMPARED)]
    apart = texts_apart(stream, hot)
    found = apart.count()
    own = F.lit(found > few)
    if 0 < found <= few:
        marked = F.broadcast(apart.withColumn("_own", F.lit(True)))
        hot = hot.join(marked, F.col("id").eqNullSafe(F.col("_key")), "left")
        own = F.coalesce("_own", F.lit(False))
    cleaned = clean_text(F.col("title"), F.col("selftext"))
    as_cleaned = F.col("text_combined").eqNullSafe(cleaned)

    def box(kept: dict[str, Column], own: Column, cleanable: Column) -> Column:
        return F.struct(*[kept.get(c, F.col(c)).alias(c) for c in names], own.alias("_own"), cleanable.alias("_cleanable"))

    stored = F.when(~as_cleaned, F.col("text_combined"))
    stream_box = box({"text_combined": stored}, F.lit(True), as_cleaned)
    hot_box = box({c: F.when(own, F.col(c)) for c in _TEXTS}, own, F.lit(True))
    copies = _copies(stream, F.lit(None).cast("string"), stream_box), _copies(hot, F.col("fetch_timestamp"), hot_box)
    won = _best_copies(*copies, [*stream.columns, "_cleanable"], _TEXTS)
    again = F.when(F.col("_cleanable"), cleaned).otherwise(F.col("text_combined"))
    is_hot = F.col("data_source") == HOT
    return won.withColumn("text_combined", again).withColumns(
        {
            "text_length": F.when(is_hot, F.length("text_combined")).otherwise(F.col("text_length")),
            "title_length": F.when(is_hot, F.length("title")).otherwise(F.col("title_length")),
        }
    ).select(*stream.columns)


def _hot_history(bronze: DataFrame, since: Column, cfg: Settings, *also: str) -> DataFrame:
    # Every boxed column is used later: a half-used box would be opened before the shuffle.
    used = bronze.drop("created_utc", "is_original_content", "fetch_source", "fetch_hour", "has_media")
    copies = box_history(used, "fetch_ts", since, ["id", "fetch_timestamp", "fetch_ts", "score", "num_comments", *also])
    return harmonise_hot(_unboxed(copies, used.columns), cfg, False, "fetch_timestamp", *also)


def merge_history(
    silver: DataFrame, bronze: DataFrame, as_of: AsOf, hours: int, cfg: Settings = Settings()
) -> DataFrame:
    """`merge_sources` over the whole history, complete for rows of the last `hours` only.

    The winner of each id is the same as in `merge_sources`; a winner older than the window comes back
    with its sort columns alone, to be counted and then dropped by the recency filter.
    """
    since = hours_before(as_of, hours)
    hot = _hot_history(bronze, since, cfg)
    keep = ["id", *_COMPARED]
    rest = F.when(F.col("processed_ts") >= since, F.expr(_rest([c for c in hot.columns if c != "fetch_timestamp"], keep)))
    stream = box_history(mark_stream(silver), "processed_ts", since, keep)
    columns = [c for c in hot.columns if c != "fetch_timestamp"]
    none = F.lit(None).cast("string")
    pair = _copies(stream, none, F.col("_rest")), _copies(hot, F.col("fetch_timestamp"), rest)
    return fill_hot_text(_best_copies(*pair, columns))


def history_places(
    silver: DataFrame, bronze: DataFrame, as_of: AsOf, hours: int, cfg: Settings = Settings()
) -> DataFrame:
    """The winners of `merge_history` over `placed` tables as id, sort columns and place, which is null for a winner
    older than the window. No text crosses the exchange.
    """
    since = hours_before(as_of, hours)
    keep = ["id", *_COMPARED, *PLACE]
    place = F.when(F.col("processed_ts") >= since, F.struct(*PLACE))
    stream = box_history(mark_stream(silver, *PLACE), "processed_ts", since, keep).select(*keep)
    hot = _hot_history(bronze, since, cfg, *PLACE)
    pair = _copies(stream, F.lit(None).cast("string"), place), _copies(hot, F.col("fetch_timestamp"), place)
    return _best_copies(*pair, keep)


def merged_at(
    silver: DataFrame, bronze: DataFrame, marked: DataFrame, as_of: AsOf, hours: int, cfg: Settings = Settings()
) -> DataFrame:
    """The merged posts at marked places of `placed` tables, all within the window, and their places."""
    since = hours_before(as_of, hours)
    stream = mark_stream(at_places(_since(silver, "processed_ts", since), marked), *PLACE)
    hot = harmonise_hot(at_places(_since(bronze, "fetch_ts", since), marked), cfg, False, *PLACE)
    return fill_hot_text(stream.unionByName(hot))
