"""Secret scans: strong matches stand alone, weak parts count only beside their complements. Built-in functions only.

Strong kinds are the base patterns. Weak parts are access identifiers, secret-like values and endpoints; each alone is
too common to report. Parts of one text are linked by an interval join: two are in one scope if their starts lie at
most SCOPE code points apart, wherever in the text they stand. All parts of a text are sorted by start, and one sweep
forward and one backward carry the nearest part of each role along, so no pair of parts is built. A sweep works by
doubling: round k joins what lies 2**k places apart, and n parts take log n rounds. Nothing is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points between the starts of two parts that belong together, at most.
SCOPE = 400

# --- Fixed values: base patterns, in the order in which kinds are listed ----------------
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"

# --- Weak parts by role: the method's own -----------------------------------------------
IDENTIFIER = (
    r"\b(?:(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{8,}|(?i:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,})"""
)
# A run of key characters is tried at its first start alone (the look behind): what a later one finds, the first finds.
SECRET = (
    r"""\b(?:(?i:pwd|passphrase|auth|bearer|private_?key|credential)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
    r"|(?=[A-Za-z0-9+/]{32})(?<!\b[A-Za-z0-9]{1,256}[+/]{0,8})(?=[A-Za-z+/]*+[0-9])(?=[0-9a-z+/]*+[A-Z])"
    r"[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/])|[0-9a-f]{16,23}(?![0-9A-Za-z]))"
)
ENDPOINT = r"\b(?:(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]{3,}|(?i:host|endpoint|server)\x20*[:=]\x20*[A-Za-z0-9.-]{4,}|[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{2,5})"

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
STRONG_ROLE = {"access": "identifier", "assign": "secret", "hex": "secret"}
WEAK = {"identifier": IDENTIFIER, "secret": SECRET, "endpoint": ENDPOINT}
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _matches(pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(group))


def _sweep(values: str, joined: str, ahead: bool = False) -> str:
    """Each entry joined with all before it (or behind it, if `ahead`). `joined` is an expression of `a` and `b`, where
    `b` may be null: there is none."""
    other = f"get(acc, i {'+' if ahead else '-'} shiftleft(1, k))"
    step = joined.replace("{b}", other).replace("{a}", "v")
    return (
        f"transform(array({values}), x -> aggregate(sequence(0, cast(floor(log2(greatest(size(x), 1))) AS int)), x, "
        f"(acc, k) -> transform(acc, (v, i) -> {step})))[0]"
    )


def _spans(kind: str, pattern: str, found: str, keep: str = "true") -> Column:
    """Code point spans of the matches in column `found`: gaps between matches come from a split at the pattern.

    `keep` is a condition on `m` (the match). Matches that fail it are dropped, not retried.
    """
    literal = pattern.replace("\\", "\\\\").replace("'", "\\'")
    # A match ends where all gaps and matches up to it end. Split and ends are bound once, as the one entry of an array.
    ends = _sweep(f"transform({found}, (m, i) -> length(g[i]) + length(m))", "{a} + coalesce({b}, 0)")
    span = f"named_struct('start', e[i] - length(m), 'rank', {KINDS.index(kind)}, 'end', e[i], 'kind', '{kind}')"
    fold = (
        f"transform(array(split(text, '{literal}')), g -> transform(array({ends}), e -> "
        f"filter(transform({found}, (m, i) -> CASE WHEN {keep} THEN {span} END), s -> s IS NOT NULL))[0])[0]"
    )
    return F.expr(f"CASE WHEN size({found}) = 0 THEN cast(array() AS {SPAN}) ELSE {fold} END")


def _digest_form(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _strong(span: str) -> str:
    return f"{span}.rank < {KINDS.index('identifier')}"


def _of_role(span: str, role: str) -> str:
    kinds = [role, *[k for k, r in STRONG_ROLE.items() if r == role]]
    return f"{span}.kind IN ({', '.join(repr(k) for k in kinds)})"


def _clear(spans: str) -> str:
    """The strong spans, and the weak ones that overlap none of them; `spans` are sorted."""
    ends = _sweep(f"transform({spans}, s -> CASE WHEN {_strong('s')} THEN s.end END)", "greatest({a}, {b})")
    starts = _sweep(f"transform({spans}, s -> CASE WHEN {_strong('s')} THEN s.start END)", "least({a}, {b})", True)
    alone = f"{_strong('s')} OR NOT (coalesce(e[i] > s.start, false) OR coalesce(n[i] < s.end, false))"
    return f"transform(array({ends}), e -> transform(array({starts}), n -> filter({spans}, (s, i) -> {alone}))[0])[0]"


def _nearest(spans: str, role: str) -> Column:
    """For each span, whether a part of the role starts at most SCOPE before or behind its start."""
    own = f"transform({spans}, s -> CASE WHEN {_of_role('s', role)} THEN s.start END)"
    before, behind = _sweep(own, "greatest({a}, {b})"), _sweep(own, "least({a}, {b})", True)
    near = f"coalesce(s.start - e[i] <= {SCOPE}, false) OR coalesce(n[i] - s.start <= {SCOPE}, false)"
    return F.expr(
        f"CASE WHEN _any THEN transform(array({before}), e -> transform(array({behind}), n -> "
        f"transform({spans}, (s, i) -> {near}))[0])[0] END"
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """`docs` with base (strong spans) and spans (strong and linked weak spans), both sorted by start and kind.

    A span is (start, rank, end, kind) in code points, end exclusive. Null and empty texts have none. Overlapping
    strong spans of different kinds all stay; a weak part that overlaps a strong span is dropped, and of two weak
    parts at the same place both may stay. A weak identifier needs a secret in its scope, a weak secret an identifier
    or an endpoint, an endpoint both. Repeated rows and ties come out alike; an empty table stays empty. Input
    columns named `base` or `spans` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    rows = docs.select(F.struct(*kept).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "_row", "text",
        _matches(ASSIGN).alias("_assign"),
        F.when(F.contains("text", F.lit("AKIA")), _matches(ACCESS)).otherwise(F.expr("cast(array() AS array<string>)")).alias("_access"),
        _matches(HEX).alias("_hex"),
    )
    value = "length(regexp_extract(m, '^[^:=]*[:=]\\\\x20*[\"\\']?(.*)$', 1)) >= 6"
    rows = rows.select(
        "_row", "text",
        F.concat(
            _spans("assign", ASSIGN, "_assign", value),
            _spans("access", ACCESS, "_access", "length(m) >= 20"),
            _spans("hex", HEX, "_hex"),
        ).alias("_base"),
    )
    rows = rows.select("_row", "text", F.array_sort("_base").alias("base"), *[_matches(p).alias(f"_{r}") for r, p in WEAK.items()])
    rows = rows.select("_row", "base", *[_spans(r, p, f"_{r}").alias(f"_{r}") for r, p in WEAK.items()])
    any_weak = F.expr(" + ".join(f"size(_{r})" for r in WEAK)) > 0
    rows = rows.select("_row", "base", any_weak.alias("_any"), F.array_sort(F.concat("base", *[f"_{r}" for r in WEAK])).alias("_all"))
    rows = rows.select("_row", "base", "_any", F.expr(f"CASE WHEN _any THEN {_clear('_all')} END").alias("_all"))
    rows = rows.select("*", *[_nearest("_all", r).alias(f"_near_{r}") for r in WEAK])
    linked = (
        f"{_strong('s')} OR CASE s.kind WHEN 'identifier' THEN _near_secret[i] "
        "WHEN 'secret' THEN _near_identifier[i] OR _near_endpoint[i] ELSE _near_identifier[i] AND _near_secret[i] END"
    )
    spans = F.expr(f"CASE WHEN _any THEN filter(_all, (s, i) -> {linked}) ELSE base END")
    return rows.select("_row.*", "base", spans.alias("spans"))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, strong counts by kind, the digest of the strong spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:3]],
        F.sha2(_digest_form("base"), 256).alias("base_sha256"), _digest_form("spans").alias("spans"),
    )
