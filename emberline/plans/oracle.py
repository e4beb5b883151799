"""SQL counterparts of the registered queries, written for DuckDB from the rules and not from the Spark code."""

_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
_HOUR_EARLIER = "TIMESTAMP '2024-01-30 23:00:00'"
_QUIET = "TIMESTAMP '2024-02-01 12:00:00'"


def _r(expression: str) -> str:
    """Nine places; the added zero turns a negative zero positive."""
    return f"(round({expression}, 9) + 0e0)"


def _t(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


_ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

_SUBMISSION = """
submission AS MATERIALIZED (
  SELECT e.event_id, e.ts, e.event_type, 'p' || e.event_id AS id,
         substring(d.text, 1, 80) AS title, nullif(substring(d.text, 81), '') AS selftext, d.lang AS subreddit,
         CASE WHEN e.user_id % 50 = 1 THEN '[removed]' WHEN e.user_id % 50 > 1 THEN 'u' || e.user_id END AS author,
         floor(epoch(e.ts))::DOUBLE AS created_utc,
         'https://example.org/p' || e.event_id AS url, '/' || d.lang || '/p' || e.event_id AS permalink,
         e.event_id % 10 = 0 AS over_18, e.event_id % 17 = 0 AS spoiler,
         CASE e.event_id % 3 WHEN 0 THEN d.source WHEN 1 THEN '' END AS link_flair_text,
         floor(e.value)::BIGINT AS score, floor(e.value)::BIGINT + e.event_id % 5 AS ups, e.event_id % 5 AS downs,
         CASE WHEN e.event_id % 97 <> 0 THEN 0.5e0 + (e.event_id % 50) / 100.0e0 END AS upvote_ratio,
         json_extract_string(e.props, '$.k')::BIGINT AS num_comments,
         CASE WHEN e.event_id % 41 <> 0 THEN e.event_id % 4 END AS total_awards_received,
         e.event_type = 'view' AS is_video, e.event_type IN ('signup', 'error', 'click') AS is_self,
         CASE WHEN e.event_id % 7 <> 0 THEN e.event_id % 2 = 0 END AS is_original_content,
         CASE WHEN e.event_id % 23 = 0 THEN TRUE WHEN e.event_id % 5 <> 0 THEN FALSE END AS stickied
  FROM events e CROSS JOIN (SELECT count(*) AS n FROM documents) c
  JOIN documents d ON d.doc_id = e.event_id % c.n)"""


def _features(ts: str) -> str:
    return f"""
         trim(lower(regexp_replace(concat_ws(' ', title, coalesce(selftext, '')), '[^a-zA-Z0-9 ]', ' ', 'g')))
           AS text_combined,
         length(trim(lower(regexp_replace(concat_ws(' ', title, coalesce(selftext, '')), '[^a-zA-Z0-9 ]', ' ', 'g'))))
           AS text_length,
         length(title) AS title_length,
         score * 0.5e0 + num_comments * 0.3e0 + num_awards * 0.2e0 AS engagement_score,
         CASE WHEN score > 0 THEN num_comments::DOUBLE / score ELSE 0e0 END AS comment_to_score_ratio,
         hour({ts}) AS hour_of_day, dayofweek({ts}) + 1 AS day_of_week,
         CASE WHEN dayofweek({ts}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""


_SILVER = f"""
event AS (
  SELECT id, title, coalesce(selftext, '') AS selftext, subreddit, coalesce(author, '[deleted]') AS author,
         created_utc, url, permalink, over_18, spoiler,
         CASE WHEN link_flair_text <> '' THEN link_flair_text ELSE 'unknown' END AS link_flair_text,
         score, ups, downs, upvote_ratio AS ratio, num_comments, total_awards_received AS num_awards,
         is_video, is_video AS has_media, ts, date_trunc('second', ts) AS created_ts
  FROM submission),
silver AS MATERIALIZED (
  SELECT id, title, selftext, subreddit, author, created_ts, url, permalink, over_18, spoiler, link_flair_text,
         score, ups, downs, ratio, num_comments, num_awards, is_video, has_media,{_features("created_ts")},
         CASE WHEN is_video THEN 'video' WHEN trim(selftext) <> '' THEN 'text' ELSE 'link' END AS content_type,
         ts::DATE AS processing_date, ts AS processed_ts, 'stream' AS data_source
  FROM event)"""

_COPIES = """
copies AS MATERIALIZED (
  SELECT * EXCLUDE (author, score, total_awards_received, is_original_content, selftext, copy),
         coalesce(author, 'None') AS author, greatest(score + event_id % 100 - 50 - copy * 5, 0) AS score,
         coalesce(total_awards_received, 0) AS total_awards_received,
         coalesce(is_original_content, FALSE) AS is_original_content, coalesce(selftext, '') AS selftext,
         ts + to_hours(1 + 6 * copy) AS fetched_at, copy
  FROM (SELECT *, unnest(range(0, event_id % 2 + 1)) AS copy FROM submission))"""

_HOT = f"""
latest AS MATERIALIZED (
  SELECT * FROM copies
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC, score DESC, num_comments DESC) = 1)"""


def _harmonised(source: str) -> str:
    return f"""
  SELECT id, title, selftext, subreddit, author, created_ts, url, permalink, over_18, spoiler, link_flair_text,
         score, ups, downs, upvote_ratio AS ratio, num_comments, num_awards, is_video, is_video AS has_media,
         {_features("created_ts").strip()},
         CASE WHEN is_video THEN 'video' WHEN is_self THEN 'text' ELSE 'link' END AS content_type,
         fetched_at::DATE AS processing_date, fetched_at AS processed_ts, 'hot_api' AS data_source
  FROM (SELECT *, total_awards_received AS num_awards, date_trunc('second', ts) AS created_ts FROM {source})"""


_MERGED = f"""
hot AS ({_harmonised("latest")}),
merged AS MATERIALIZED (
  SELECT * FROM (SELECT * FROM silver UNION ALL BY NAME SELECT * FROM hot)
  QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY score DESC NULLS LAST, processed_ts DESC, data_source, num_comments DESC) = 1)"""

_BASE = f"{_SUBMISSION},{_SILVER},{_COPIES},{_HOT},{_MERGED}"


def _recent(as_of: str) -> str:
    return f"""
recent AS MATERIALIZED (
  SELECT * FROM merged, (SELECT count(*) AS fresh FROM merged WHERE processed_ts >= {as_of} - INTERVAL 24 HOUR)
  WHERE processed_ts >= {as_of} - CASE WHEN fresh > 0 THEN INTERVAL 24 HOUR ELSE INTERVAL 48 HOUR END)"""


def _viral(min_score: int) -> str:
    alive = "author NOT IN ('[deleted]', '[removed]')"
    strict = f"score >= {min_score} AND num_comments >= 5 AND {alive} AND text_length > 10"
    relaxed = f"score >= 10 AND num_comments >= 1 AND {alive} AND text_length > 5"
    return f"""
viral AS MATERIALIZED (
  SELECT * FROM recent, (SELECT count(*) AS met FROM recent WHERE {strict})
  WHERE CASE WHEN met > 0 THEN {strict} ELSE {relaxed} END)"""


def _scored(source: str) -> str:
    return f"""
scored AS MATERIALIZED (
  SELECT *, 0.4e0 * score_norm + 0.3e0 * comments_norm + 0.2e0 * awards_norm + 0.1e0 * ratio AS viral_score
  FROM (SELECT v.*, score::DOUBLE / ms AS score_norm, num_comments::DOUBLE / mc AS comments_norm,
               CASE WHEN ma > 0 THEN num_awards::DOUBLE / ma ELSE 0e0 END AS awards_norm
        FROM {source} v, (SELECT max(score) AS ms, max(num_comments) AS mc, max(num_awards) AS ma FROM {source})))"""


_ARCHETYPES = """
archetypes AS MATERIALIZED (
  SELECT *, row_number() OVER (
    ORDER BY viral_score DESC NULLS LAST, engagement_score DESC NULLS LAST, score DESC NULLS LAST,
             processed_ts DESC, data_source, id) AS archetype_rank
  FROM scored QUALIFY archetype_rank <= 40)"""

_FOUND = f"{_BASE},{_recent(_AS_OF)},{_viral(50)},{_scored('viral')},{_ARCHETYPES}"


def _predicted(source: str, name: str = "predicted") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT *, CASE WHEN is_already_viral THEN 'ALREADY_VIRAL' WHEN viral_similarity_score >= 0.65e0 THEN 'HIGH'
                 WHEN viral_similarity_score >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS viral_potential_label,
         is_already_viral OR viral_similarity_score >= 0.65e0 AS is_viral
  FROM (
    SELECT s.*, coalesce(s.score >= 100, FALSE) AS is_already_viral,
           least(1e0, coalesce(sc.n / 40e0, 0e0) * 0.3e0 + coalesce(tc.n / 40e0, 0e0) * 0.2e0
             + CASE WHEN s.engagement_score IS NOT NULL AND ae > 0
                    THEN least(s.engagement_score / ae, 1e0) ELSE 0e0 END * 0.25e0
             + CASE WHEN s.text_length IS NOT NULL AND al > 0
                    THEN greatest(0e0, 1e0 - abs(s.text_length - al) / al) ELSE 0e0 END * 0.15e0
             + CASE WHEN s.ratio IS NOT NULL AND ar > 0
                    THEN least(s.ratio / ar, 1e0) ELSE 0e0 END * 0.1e0) AS viral_similarity_score
    FROM {source} s
    CROSS JOIN (SELECT avg(engagement_score) AS ae, avg(text_length) AS al, avg(ratio) AS ar FROM archetypes)
    LEFT JOIN (SELECT subreddit AS k, count(*) AS n FROM archetypes GROUP BY 1) sc ON sc.k = s.subreddit
    LEFT JOIN (SELECT content_type AS k, count(*) AS n FROM archetypes GROUP BY 1) tc ON tc.k = s.content_type))"""


def _candidates(as_of: str = _AS_OF, name: str = "candidates") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT * FROM silver
  WHERE processed_ts >= {as_of} - INTERVAL 24 HOUR AND id NOT IN (SELECT id FROM archetypes))"""


_PREDICTED = f"{_FOUND},{_candidates()},{_predicted('candidates')}"


def _prediction_columns(as_of: str) -> str:
    return f"""id, title, subreddit, author, score, num_comments, {_r("engagement_score")} AS engagement_score,
         {_r("viral_similarity_score")} AS viral_similarity_score, viral_potential_label, is_viral, is_already_viral,
         content_type, text_length, {_t("created_ts")} AS created_ts, {_t("processed_ts")} AS processed_ts,
         {_t(as_of)} AS prediction_timestamp, CAST({as_of}::DATE AS VARCHAR) AS prediction_date"""


_TWO_RUNS = f"""{_FOUND},{_candidates(_HOUR_EARLIER, "c1")},{_predicted("c1", "p1")},
{_candidates(_AS_OF, "c2")},{_predicted("c2", "p2")},
runs AS (SELECT {_prediction_columns(_HOUR_EARLIER)} FROM p1 UNION ALL SELECT {_prediction_columns(_AS_OF)} FROM p2)"""

_LISTINGS = """
listings AS MATERIALIZED (
  SELECT *, listing <> 'all' AS later
  FROM (SELECT *, unnest(CASE WHEN score >= 100 THEN ['all', subreddit] ELSE [subreddit] END) AS listing
        FROM submission)),
fetched AS MATERIALIZED (
  SELECT * FROM (SELECT * FROM listings
                 QUALIFY row_number() OVER (PARTITION BY listing ORDER BY event_id) <= 50)
  WHERE NOT coalesce(stickied, FALSE)),
fetch_counts AS (
  SELECT r.listing, count(f.id) AS posts
  FROM (SELECT DISTINCT lang AS listing FROM documents UNION ALL VALUES ('all'), ('nowhere')) r
  LEFT JOIN fetched f ON f.listing = r.listing GROUP BY 1)"""

_MESSAGES = """
deliveries AS (
  SELECT *, unnest(CASE WHEN event_type = 'purchase' THEN [1, 1] ELSE [1] END) AS delivery FROM submission)"""


def _common(source: str, *extra: str) -> str:
    more = "".join(f", {e}" for e in extra)
    return f"""
SELECT id, title, md5(selftext) AS selftext, subreddit, author, {_t("created_ts")} AS created_ts, url, permalink,
       over_18, spoiler, link_flair_text, score, ups, downs, {_r("ratio")} AS ratio, num_comments, num_awards,
       is_video, has_media, md5(text_combined) AS text_combined, text_length, title_length,
       {_r("engagement_score")} AS engagement_score, {_r("comment_to_score_ratio")} AS comment_to_score_ratio,
       content_type, hour_of_day, day_of_week, is_weekend,
       CAST(processing_date AS VARCHAR) AS processing_date, {_t("processed_ts")} AS processed_ts, data_source{more}
FROM {source}"""


_LISTING_FIELDS = f"""id, title, md5(selftext) AS selftext, subreddit, author, created_utc, url, permalink, over_18,
       spoiler, link_flair_text, score, ups, downs, {_r("upvote_ratio")} AS upvote_ratio, num_comments,
       total_awards_received, is_video, is_self, is_original_content,
       strftime(fetched_at, {_ISO}) AS fetch_timestamp, 'hot' AS fetch_source"""

_ARCHETYPE_EXTRA = (
    f"{_r('score_norm')} AS score_norm",
    f"{_r('comments_norm')} AS comments_norm",
    f"{_r('awards_norm')} AS awards_norm",
    f"{_r('viral_score')} AS viral_score",
    "archetype_rank",
    "'2024-01-31' AS extraction_date",
    f"{_t(_AS_OF)} AS extraction_timestamp",
)

_GROUPED = f"count(*) AS count, {_r('avg(score)')} AS avg_score, {_r('avg(viral_score)')} AS avg_viral_score"

_TOTALS = f"""count(*) AS {{total}}, count(*) FILTER (viral_potential_label = 'ALREADY_VIRAL') AS already_viral,
       count(*) FILTER (viral_potential_label = 'HIGH') AS high_potential,
       count(*) FILTER (viral_potential_label = 'MEDIUM') AS medium_potential,
       count(*) FILTER (viral_potential_label = 'LOW') AS low_potential,
       {_r("avg(viral_similarity_score)")} AS {{mean}}, {_r("max(viral_similarity_score)")} AS {{top}}"""

# Tokens: split at each white space, trailing empty words dropped. The text is trimmed, so none trail.
_TERMS = """
words AS (SELECT id, unnest(regexp_split_to_array(text_combined, '\\s')) AS term FROM archetypes),
tf AS (SELECT id, term, count(*) AS tf FROM words GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""



# --- Fixed values: constants of the public 32-bit MurmurHash3, and the seed of the feature hash -----
_C1, _C2, _ADD, _F1, _F2, _SEED = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35, 42


def _wrap(x: str) -> str:
    return f"(({x}) % 4294967296::UBIGINT)"


def _rotate(x: str, by: int) -> str:
    return f"({_wrap(f'{x} * {1 << by}::UBIGINT')} + {x} // {1 << (32 - by)}::UBIGINT)"


def _scramble(k: str) -> str:
    first = _wrap(f"{k} * {_C1}::UBIGINT")
    return _wrap(f"{_rotate(first, 15)} * {_C2}::UBIGINT")


def _bytes(start: str, number: str) -> str:
    """`number` bytes of the ASCII term from `start` (1-based), as a little-endian number."""
    parts = [
        f"CASE WHEN {at} < {number} THEN ascii(substring(term, {start} + {at}, 1)) * {256**at}::UBIGINT ELSE 0::UBIGINT END"
        for at in range(4)
    ]
    return "(" + " + ".join(parts) + ")"


# One step per common table expression; terms are ASCII, so characters are bytes.
_HASHED = f"""
vocabulary AS MATERIALIZED (SELECT DISTINCT term, length(term) AS size FROM words),
blocks AS MATERIALIZED (
  SELECT term, size, [{_scramble("k")} FOR k IN ks] AS ks, {_scramble("rest")} AS rest
  FROM (SELECT term, size, [{_bytes("(4 * i + 1)::INT", "4")} FOR i IN range(size // 4)] AS ks,
               {_bytes("(size // 4 * 4 + 1)::INT", "size % 4")} AS rest FROM vocabulary)),
body AS MATERIALIZED (
  SELECT term, size, rest,
         list_reduce(ks, lambda h, k: {_wrap(f"{_rotate('xor(h, k)', 13)} * 5::UBIGINT + {_ADD}::UBIGINT")},
                     {_SEED}::UBIGINT) AS h FROM blocks),
final1 AS MATERIALIZED (SELECT term, xor(xor(h, rest), size::UBIGINT) AS h FROM body),
final2 AS MATERIALIZED (SELECT term, {_wrap(f"xor(h, h // 65536::UBIGINT) * {_F1}::UBIGINT")} AS h FROM final1),
final3 AS MATERIALIZED (SELECT term, {_wrap(f"xor(h, h // 8192::UBIGINT) * {_F2}::UBIGINT")} AS h FROM final2),
final4 AS MATERIALIZED (SELECT term, xor(h, h // 65536::UBIGINT)::BIGINT AS h FROM final3),
buckets AS MATERIALIZED (
  SELECT term, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 100 + 100) % 100 AS bucket FROM final4),
counted AS MATERIALIZED (
  SELECT id, bucket, count(*) AS tf FROM words JOIN buckets USING (term) GROUP BY 1, 2),
spread AS (SELECT bucket, count(*) AS df FROM counted GROUP BY 1),
weights AS (
  SELECT id, bucket, tf * ln((n + 1e0) / (df + 1e0)) AS weight
  FROM counted JOIN spread USING (bucket), (SELECT count(*) AS n FROM archetypes))"""

_DAY_TOP = "viral_similarity_score DESC, id"

_STREAM_SILVER = f"""
event AS (
  SELECT id, substring(title, 1, 500) AS title, substring(coalesce(selftext, ''), 1, 2000) AS selftext, subreddit,
         coalesce(author, '[deleted]') AS author, url, permalink, over_18, spoiler,
         CASE WHEN link_flair_text <> '' THEN link_flair_text ELSE 'unknown' END AS link_flair_text,
         score, ups, downs, upvote_ratio AS ratio, num_comments, total_awards_received AS num_awards,
         is_video, is_video AS has_media, ts, date_trunc('second', ts) AS created_ts
  FROM submission WHERE event_type <> 'error'),
silver AS (
  SELECT *,{_features("created_ts")},
         CASE WHEN is_video THEN 'video' WHEN trim(selftext) <> '' THEN 'text' ELSE 'link' END AS content_type,
         ts::DATE AS processing_date, ts AS processed_ts
  FROM event)"""


def oracle() -> dict[str, str]:
    sql = {
        "normalise_events": f"""WITH {_SUBMISSION}
SELECT id, substring(title, 1, 500) AS title, substring(coalesce(selftext, ''), 1, 2000) AS selftext, subreddit,
       coalesce(author, '[deleted]') AS author, created_utc, url, permalink, over_18, spoiler,
       CASE WHEN link_flair_text <> '' THEN link_flair_text ELSE 'unknown' END AS link_flair_text,
       score, ups, downs, {_r("upvote_ratio")} AS ratio, num_comments, total_awards_received AS num_awards,
       is_video, is_video AS has_media, strftime(ts, {_ISO}) AS ingestion_timestamp
FROM submission""",
        "normalise_listing": f"WITH {_SUBMISSION},{_COPIES} SELECT {_LISTING_FIELDS} FROM copies",
        "bronze_derived": f"""WITH {_SUBMISSION},{_COPIES}
SELECT id, {_t("date_trunc('second', ts)")} AS created_ts, {_t("fetched_at")} AS fetch_ts,
       CAST(fetched_at::DATE AS VARCHAR) AS fetch_date, hour(fetched_at) AS fetch_hour, is_video AS has_media
FROM copies""",
        "post_features": f"""WITH {_SUBMISSION},{_SILVER},{_COPIES},
every AS (SELECT * FROM silver UNION ALL BY NAME ({_harmonised("copies")}))
{_common("every")}""",
        "listing_top_n_per_group": f"""WITH {_SUBMISSION},{_LISTINGS}
SELECT listing, event_id AS listing_pos, id, score FROM fetched""",
        "listing_dedup_first": f"""WITH {_SUBMISSION},{_LISTINGS}
SELECT id, listing, score FROM listings
QUALIFY row_number() OVER (PARTITION BY id ORDER BY later, event_id) = 1""",
        "duplicate_audit": f"""WITH {_SUBMISSION},{_LISTINGS}
SELECT count(*) AS total_posts, count(DISTINCT id) AS unique_posts, count(*) - count(DISTINCT id) AS duplicates
FROM listings""",
        "source_counts": f"WITH {_SUBMISSION},{_LISTINGS} SELECT listing, posts FROM fetch_counts",
        "fetch_summary": f"""WITH {_SUBMISSION},{_LISTINGS}
SELECT '2024-01-31T00:00:00' AS fetch_datetime, count(*) AS total_posts, count(DISTINCT id) AS unique_posts,
       count(*) - count(DISTINCT id) AS duplicates_removed,
       (SELECT count(*) FROM fetch_counts) AS subreddits_fetched, 'bronze' AS output_path,
       (SELECT '{{' || string_agg('"' || listing || '":' || posts, ',' ORDER BY listing) || '}}' FROM fetch_counts)
         AS fetch_stats
FROM fetched""",
        "subreddit_summary": f"""WITH {_SUBMISSION},{_COPIES}
SELECT subreddit, count(*) AS posts, {_r("avg(score)")} AS avg_score, max(score) AS max_score,
       {_r("avg(num_comments)")} AS avg_comments, {_r("avg(upvote_ratio)")} AS avg_ratio
FROM copies GROUP BY 1""",
        "content_type_summary": f"""WITH {_SUBMISSION},{_COPIES}
SELECT CASE WHEN is_video THEN 'video' WHEN is_self THEN 'text' ELSE 'link' END AS content_type,
       count(*) AS count, {_r("avg(score)")} AS avg_score
FROM copies GROUP BY 1""",
        "top_posts": f"""WITH {_SUBMISSION},{_COPIES},{_HOT}
SELECT title, subreddit, score, num_comments, {_r("upvote_ratio")} AS upvote_ratio,
       {_t("date_trunc('second', ts)")} AS created_ts
FROM latest QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 10""",
        "sample_posts": f"""WITH {_SUBMISSION},{_COPIES},{_HOT}
SELECT id, title, subreddit, score, num_comments, {_r("upvote_ratio")} AS upvote_ratio
FROM latest QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 10""",
        "bronze_roundtrip": f"""WITH {_SUBMISSION},{_COPIES}
SELECT {_LISTING_FIELDS}, {_t("date_trunc('second', ts)")} AS created_ts, {_t("fetched_at")} AS fetch_ts,
       CASE copy WHEN 0 THEN '2024-01-30' ELSE '2024-01-31' END AS fetch_date,
       CASE copy WHEN 0 THEN 18 ELSE 0 END AS fetch_hour, is_video AS has_media,
       CASE copy WHEN 0 THEN '2024-01-30_18-00' ELSE '2024-01-31_00-00' END AS batch
FROM copies""",
        "bronze_batch_list": f"""WITH {_SUBMISSION},{_COPIES}
SELECT CASE copy WHEN 0 THEN '2024-01-30_18-00' ELSE '2024-01-31_00-00' END AS batch, count(*) AS posts
FROM copies GROUP BY 1""",
        "bronze_skipped_files": f"""WITH {_SUBMISSION},{_COPIES},
stored AS (
  SELECT CASE copy WHEN 0 THEN '2024-01-30_18-00' ELSE '2024-01-31_00-00' END AS batch, subreddit, count(*) AS n
  FROM copies GROUP BY ALL)
SELECT batch, subreddit, n AS promised, n AS delivered, 0 AS lost FROM stored
UNION ALL
SELECT '2024-02-01_00-00', subreddit, n, 0, n FROM stored
WHERE batch = '2024-01-31_00-00' AND subreddit = (SELECT min(lang) FROM documents)
UNION ALL
SELECT '2024-02-01_00-00', 'none', NULL, 0, NULL""",
        "date_range": """SELECT CAST(min(ts)::DATE AS VARCHAR) AS min_date, CAST(max(ts)::DATE AS VARCHAR) AS max_date
FROM events""",
        "silver_days": "SELECT CAST(ts::DATE AS VARCHAR) AS processing_date, count(*) AS posts FROM events GROUP BY 1",
        "hot_dedup_latest": f"""WITH {_SUBMISSION},{_COPIES},{_HOT}
SELECT id, score, num_comments, strftime(fetched_at, {_ISO}) AS fetch_timestamp, subreddit, md5(selftext) AS body
FROM latest""",
        "merged_posts": f"WITH {_BASE} {_common('merged')}",
        "recent_posts": f"WITH {_BASE},{_recent(_AS_OF)} {_common('recent')}",
        "recent_posts_fallback": f"""WITH {_BASE},{_recent(_QUIET)}
SELECT id, score, {_t("processed_ts")} AS processed_ts, data_source FROM recent""",
        "viral_posts_tiered": f"""WITH {_BASE},{_recent(_AS_OF)},{_viral(50)}
SELECT id, score, num_comments, author, text_length FROM viral""",
        "viral_posts_relaxed": f"""WITH {_BASE},{_recent(_AS_OF)},{_viral(1_000_000)}
SELECT id, score, num_comments, author, text_length FROM viral""",
        "viral_maxima": f"""WITH {_BASE},{_recent(_AS_OF)},{_viral(50)}
SELECT max(score) AS max_score, max(num_comments) AS max_comments, max(num_awards) AS max_awards FROM viral""",
        "viral_scores": f"""WITH {_BASE},
meeting AS (SELECT * FROM merged WHERE score >= 50 AND num_comments >= 5 AND text_length > 10
            AND author NOT IN ('[deleted]', '[removed]')),{_scored("meeting")}
SELECT id, score, num_comments, num_awards, {_r("ratio")} AS ratio, {_r("score_norm")} AS score_norm,
       {_r("comments_norm")} AS comments_norm, {_r("awards_norm")} AS awards_norm, {_r("viral_score")} AS viral_score
FROM scored""",
        "archetypes_top40": f"WITH {_FOUND} {_common('archetypes', *_ARCHETYPE_EXTRA)}",
        "archetype_preview": f"""WITH {_FOUND}
SELECT id, title, subreddit, score, num_comments, {_r("viral_score")} AS viral_score, content_type, data_source
FROM archetypes WHERE archetype_rank <= 10""",
        "archetype_leaders": f"""WITH {_FOUND}
SELECT archetype_rank, title, subreddit, {_r("viral_score")} AS viral_score, content_type
FROM archetypes WHERE archetype_rank <= 5""",
        "archetypes_by_type": f"WITH {_FOUND} SELECT content_type, {_GROUPED} FROM archetypes GROUP BY 1",
        "archetypes_by_subreddit": f"""WITH {_FOUND} SELECT subreddit, {_GROUPED} FROM archetypes GROUP BY 1
QUALIFY row_number() OVER (ORDER BY count(*) DESC, subreddit) <= 15""",
        "archetypes_by_age": f"""WITH {_FOUND}
SELECT CASE WHEN h < 6 THEN '0-6h' WHEN h < 12 THEN '6-12h' WHEN h < 24 THEN '12-24h' ELSE '>24h' END AS time_bucket,
       count(*) AS count
FROM (SELECT (floor(epoch({_AS_OF})) - floor(epoch(processed_ts))) / 3600e0 AS h FROM archetypes) GROUP BY 1""",
        "archetype_profile": f"""WITH {_FOUND}
SELECT {_r("avg(score)")} AS avg_score, {_r("avg(num_comments)")} AS avg_comments,
       {_r("avg(engagement_score)")} AS avg_engagement, {_r("avg(text_length)")} AS avg_text_length,
       {_r("avg(title_length)")} AS avg_title_length, {_r("avg(ratio)")} AS avg_ratio
FROM archetypes""",
        "archetype_frequencies": f"""WITH {_FOUND}
SELECT 'subreddit' AS feature, subreddit AS value, count(*) AS n, {_r("count(*) / 40e0")} AS share
FROM archetypes GROUP BY 2
UNION ALL
SELECT 'content_type', content_type, count(*), {_r("count(*) / 40e0")} FROM archetypes GROUP BY 2""",
        "embedding_prep": f"""WITH {_FOUND}
SELECT id, archetype_rank, title, md5(selftext) AS selftext, md5(text_combined) AS text_combined, subreddit,
       {_r("viral_score")} AS viral_score, content_type, md5(concat_ws(' | ', title, selftext)) AS embedding_text
FROM archetypes""",
        "tfidf_vectors": f"""WITH {_FOUND},{_TERMS},{_HASHED}
SELECT w.id, a.archetype_rank, a.title, a.subreddit, {_r("a.viral_score")} AS viral_score,
       '2024-01-31' AS extraction_date, w.bucket, {_r("w.weight")} AS weight
FROM weights w JOIN archetypes a USING (id) WHERE w.weight <> 0""",
        "tfidf_terms": f"""WITH {_FOUND},{_TERMS}
SELECT id, term, tf, df, {_r("ln((n + 1e0) / (df + 1e0))")} AS idf, {_r("tf * ln((n + 1e0) / (df + 1e0))")} AS tfidf
FROM tf JOIN df USING (term), (SELECT count(*) AS n FROM archetypes)""",
        "extraction_summary": f"""WITH {_FOUND},
subs AS (SELECT subreddit, count(*) AS n FROM archetypes GROUP BY 1 ORDER BY n DESC, subreddit LIMIT 5),
types AS (SELECT content_type, count(*) AS n FROM archetypes GROUP BY 1)
SELECT '2024-01-31T00:00:00' AS extraction_timestamp, 24 AS lookback_hours,
       (SELECT count(*) FROM merged) AS total_posts_analyzed, (SELECT count(*) FROM recent) AS recent_posts,
       (SELECT count(*) FROM viral) AS viral_posts_found, (SELECT count(*) FROM archetypes) AS archetypes_extracted,
       50 AS min_score, 5 AS min_comments,
       (SELECT string_agg(subreddit, ',' ORDER BY n DESC, subreddit) FROM subs) AS top_subreddits,
       (SELECT '{{' || string_agg('"' || content_type || '":' || n, ',' ORDER BY content_type) || '}}' FROM types)
         AS content_types""",
        "candidates_anti_join": f"""WITH {_FOUND},{_candidates()}
SELECT id, score, {_t("processed_ts")} AS processed_ts FROM candidates""",
        "viral_split": """SELECT count(*) FILTER (floor(value) >= 100) AS already_viral,
       count(*) FILTER (NOT floor(value) >= 100) AS to_predict FROM events""",
        "similarity_scores": f"""WITH {_FOUND},{_predicted("silver")}
SELECT id, {_r("viral_similarity_score")} AS viral_similarity_score, viral_potential_label, is_viral FROM predicted""",
        "predictions": f"WITH {_PREDICTED} SELECT {_prediction_columns(_AS_OF)} FROM predicted",
        "label_distribution": f"""WITH {_PREDICTED}
SELECT viral_potential_label, count(*) AS count, {_r("avg(score)")} AS avg_score,
       {_r("avg(viral_similarity_score)")} AS avg_similarity
FROM predicted GROUP BY 1""",
        "type_by_label": f"""WITH {_PREDICTED}
SELECT content_type, viral_potential_label, count(*) AS count FROM predicted GROUP BY 1, 2""",
        "high_by_subreddit": f"""WITH {_PREDICTED}
SELECT subreddit, count(*) AS high_potential_posts, {_r("avg(viral_similarity_score)")} AS avg_similarity
FROM predicted WHERE viral_potential_label = 'HIGH' GROUP BY 1
QUALIFY row_number() OVER (ORDER BY count(*) DESC, subreddit) <= 15""",
        "top_high_posts": f"""WITH {_PREDICTED}
SELECT id, title, subreddit, score, num_comments, {_r("viral_similarity_score")} AS viral_similarity_score,
       content_type, {_t("processed_ts")} AS processed_ts
FROM predicted WHERE viral_potential_label = 'HIGH'
QUALIFY row_number() OVER (ORDER BY viral_similarity_score DESC, engagement_score DESC NULLS LAST, id) <= 10""",
        "prediction_totals": f"""WITH {_PREDICTED}
SELECT {_TOTALS.format(total="total_posts", mean="avg_similarity", top="max_similarity")} FROM predicted""",
        "prediction_summary": f"""WITH {_PREDICTED}
SELECT '2024-01-31T00:00:00' AS prediction_timestamp, 24 AS lookback_hours,
       (SELECT count(*) FROM archetypes) AS archetypes_used,
       {_TOTALS.format(total="posts_scored", mean="average", top="maximum")},
       0.65e0 AS high, 0.4e0 AS medium, 'predictions' AS output_path
FROM predicted""",
        "latest_predictions": f"""WITH {_TWO_RUNS}
SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY id ORDER BY prediction_timestamp DESC) = 1""",
        "predictions_roundtrip": f"WITH {_TWO_RUNS} SELECT * FROM runs",
        "predictions_rerun": f"""WITH {_PREDICTED}
SELECT id, '2024-01-31_00' AS run_id, viral_potential_label, '2024-01-31' AS prediction_date FROM predicted""",
        "sql_label_counts": f"""WITH {_PREDICTED}
SELECT viral_potential_label, count(*) AS count FROM predicted GROUP BY 1""",
        "sql_top_similarity": f"""WITH {_PREDICTED}
SELECT id, title, {_r("viral_similarity_score")} AS viral_similarity_score, is_viral
FROM predicted QUALIFY row_number() OVER (ORDER BY {_DAY_TOP}) <= 20""",
        "sql_high_posts": f"""WITH {_PREDICTED}
SELECT {_prediction_columns(_AS_OF)} FROM predicted WHERE viral_potential_label = 'HIGH'""",
        "sql_summary_of_day": f"""WITH {_PREDICTED}
SELECT viral_potential_label, count(*) AS count FROM predicted GROUP BY 1""",
        "stream_silver": f"""WITH {_SUBMISSION},{_STREAM_SILVER}
{_common("(SELECT *, '' AS data_source FROM silver)").replace(", data_source", "")}""",
        "stream_survivors": f"""WITH {_SUBMISSION}
SELECT id, score + moved AS score, ups,
       {_r("(score + moved) * 0.5e0 + num_comments * 0.3e0 + total_awards_received * 0.2e0")} AS engagement_score
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN greatest(event_id % 9 - 4, 0) ELSE 0 END AS moved
      FROM submission WHERE event_type <> 'error')""",
        "stream_ledger": f"""WITH {_SUBMISSION},{_MESSAGES}
SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS sent,
       count(*) FILTER (event_type = 'error') AS failed,
       count(DISTINCT id) FILTER (event_type <> 'error') AS stored
FROM deliveries""",
        "stream_progress": f"""WITH {_SUBMISSION},{_MESSAGES}
SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS sent,
       count(*) FILTER (event_type = 'error') AS failed, 0 AS late
FROM deliveries""",
        "stream_quarantine": f"""WITH {_SUBMISSION},{_MESSAGES}
SELECT {_t("ts")} AS timestamp, id FROM deliveries WHERE event_type = 'error'""",
        "stream_counters": f"""WITH {_SUBMISSION},{_MESSAGES}
SELECT {_t("date_trunc('minute', ts)")} AS window_start, count(*) AS processed,
       count(*) FILTER (event_type <> 'error') AS sent, count(*) FILTER (event_type = 'error') AS failed,
       {_r("count(*) FILTER (event_type <> 'error') / 60e0")} AS rate_per_second
FROM deliveries GROUP BY date_trunc('minute', ts)""",
    }
    sql["landing_to_bronze"] = sql["bronze_roundtrip"]
    # Stored and read again, another way in, another name for the table: the rows are the same.
    sql["stored_embedding_prep"] = sql["embedding_prep"]
    sql["stored_embeddings"] = sql["tfidf_vectors"]
    sql["stream_from_files"] = sql["stream_silver"]
    sql["sql_external_table"] = sql["sql_label_counts"]
    sql["latest_snapshot"] = sql["latest_predictions"]
    sql["sql_published_runs"] = sql["predictions_roundtrip"]
    # The chain sees the messages that are whole: errors arrive cut off.
    whole = "  FROM submission),\nsilver"
    assert whole in sql["predictions"]
    sql["pipeline_predictions"] = sql["predictions"].replace(whole, "  FROM submission WHERE event_type <> 'error'),\nsilver")
    return {name: text.strip() for name, text in sql.items()}
