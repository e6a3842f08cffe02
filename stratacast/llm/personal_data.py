"""Personal data: base patterns, and contexts bootstrapped from what they find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm.common import given_id, known_id, table, text_of
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The published patterns, written so that no text makes them go back and forth: a match
# begins where a run of its first class begins (or a match has just ended), and runs are
# possessive, as what follows them is never part of their class.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of 14 to 19 digits as a whole; longer and shorter runs are never cards.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain to match at all; cheap to look for.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)"

# Tokens that may be unseen identifiers: words with a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_EDGES = ".,;:!?\"'`()[]{}<>*#$%&|"
CONTEXT_CHARS = 60
RUN = 256
# Each match and the gap before it are two characters at least, or the match alone is more.
NEAR = CONTEXT_CHARS // 2
# Rounds of scoring; least evidence and confidence for a pattern or instance to count.
ROUNDS, SUPPORT, CONFIDENCE = 3, 3.0, 0.8


_NONE = "array<struct<start:int,end:int,match:string,left:string>>"


def _with_matches(rows: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Leftmost non-overlapping matches of patterns in ``text``, each where its gate holds.

    A column per pattern: array of (start, end, match, left context), the context being
    the CONTEXT_CHARS of the text before the match, earlier matches included. What a regular
    expression splits a text into, and what it matches, alternate, so their lengths
    give every position in code points. Runs of matches are placed by themselves and
    then moved by what stands before them: appending to one growing array would copy it
    for every match. Steps are columns of their own, so that none is computed twice.
    """
    none = F.array().cast(_NONE)
    def tail(text):
        return F.substring(text, -CONTEXT_CHARS, CONTEXT_CHARS)

    def start(both, r):
        near = F.slice(both, F.greatest(r * RUN + 1 - NEAR, F.lit(1)), F.lit(NEAR))
        before = F.array_join(F.transform(near, lambda x: F.concat(x["gap"], x["match"])), "")
        left = F.when(r > 0, tail(before)).otherwise("")
        return F.struct(F.lit(0).alias("at"), left.alias("left"), none.alias("out"))

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        left = tail(F.concat(state["left"], x["gap"]))
        entry = F.struct(
            start.alias("start"),
            end.alias("end"),
            x["match"].alias("match"),
            left.alias("left"),
        )
        return F.when(x["match"].isNull(), state).otherwise(
            F.struct(
                end.alias("at"),
                tail(F.concat(left, x["match"])).alias("left"),
                F.concat(state["out"], F.array(entry)).alias("out"),
            )
        )

    def place(both):
        cuts = F.sequence(F.lit(0), F.floor((F.size(both) - 1) / RUN).cast("int"))
        return F.transform(
            cuts,
            lambda r: F.aggregate(F.slice(both, r * RUN + 1, F.lit(RUN)), start(both, r), step),
        )

    def lengths(runs):
        return F.aggregate(
            runs,
            F.array(F.lit(0)),
            lambda sums, r: F.concat(sums, F.array(F.element_at(sums, -1) + r["at"])),
        )

    def moved(run, by):
        return F.transform(
            run["out"],
            lambda m: F.struct(
                (m["start"] + by).alias("start"),
                (m["end"] + by).alias("end"),
                m["match"].alias("match"),
                m["left"].alias("left"),
            ),
        )

    for name, (pattern, gate) in patterns.items():
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        rows = rows.withColumn("_f", F.when(gate, found))
        some = F.size("_f") > 0
        gaps = F.split("text", pattern, -1)
        rows = rows.withColumn(
            "_f", F.when(some, F.arrays_zip(gaps.alias("gap"), F.col("_f").alias("match")))
        )
        rows = rows.withColumn("_r", F.when(F.col("_f").isNotNull(), place(F.col("_f"))))
        rows = rows.withColumn("_b", lengths(F.col("_r")))
        all_ = F.flatten(F.zip_with("_r", F.slice("_b", 1, F.size("_r")), moved))
        rows = rows.withColumn(name, F.coalesce(F.when(F.col("_r").isNotNull(), all_), none))
    return rows.drop("_f", "_r", "_b")


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _base(kind: str, number: int) -> Column:
    """Valid spans of a kind: array of (start, kind's number, end, match, left context)."""
    return F.transform(
        F.filter(f"_{kind}", lambda m: _valid(kind, m["match"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(number).alias("kind"),
            m["end"].alias("end"),
            m["match"].alias("match"),
            m["left"].alias("left"),
        ),
    )


def _tokens() -> Column:
    """Tokens outside base spans: array of (start, end, match, left context), edges trimmed."""

    def trimmed(m):
        own = F.ltrim(m["match"], F.lit(_EDGES))
        start = m["start"] + F.length(m["match"]) - F.length(own)
        own = F.rtrim(own, F.lit(_EDGES))
        return F.struct(
            start.alias("start"),
            (start + F.length(own)).alias("end"),
            own.alias("match"),
            m["left"].alias("left"),
        )

    return F.filter(
        F.transform("_token", trimmed),
        lambda t: (t["start"] < t["end"])
        & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )


def _patterns(left: Column) -> Column:
    """Lexical patterns of a left context: its last word and its last two, if whole.

    Only the first word of a context of full length may be cut.
    """
    words = F.filter(F.split(F.lower(left), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    last = F.try_element_at(words, F.lit(-1))
    pair = F.concat_ws(" ", F.try_element_at(words, F.lit(-2)), last)
    whole = F.size(words) - (F.length(left) >= CONTEXT_CHARS).cast("int")
    return F.when(whole > 1, F.array(last, pair)).when(whole > 0, F.array(last)).otherwise(
        F.array().cast("array<string>")
    )


def _bootstrap(scanned: DataFrame) -> DataFrame:
    """Spans that contexts add: _id, _key, start, kind, end.

    Patterns and instances are the two sides of a graph. A pattern's confidence for a kind
    is the share of that kind among its different instances, and counts once the trust in
    several supports it; an instance takes the best confidence of its patterns. Rounds pass
    confidence back and forth, starting from the base spans.
    """
    of = lambda name: F.explode(name).alias("s")
    seeds = scanned.select("_id", "_key", of("base")).select(
        "_id", "_key", "s.start", "s.end", "s.match", "s.left", F.col("s.kind").alias("seed")
    )
    others = scanned.select("_id", "_key", of("tokens")).select(
        "_id", "_key", "s.start", "s.end", "s.match", "s.left", F.lit(None).cast("int").alias("seed")
    )
    places = seeds.unionByName(others).select(
        "_id", "_key", "start", "end", "seed", F.xxhash64("match").alias("instance"), "left"
    )
    places = places.withColumn("pattern", F.explode(_patterns(F.col("left")))).drop("left")
    places = materialize(places, "places")
    edges = places.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    # No instance is trusted more than 1, so fewer than SUPPORT of them never suffice.
    fair = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT)
    fair = broadcast_if_small(*materialize_sized(fair.select("pattern", "n"), "patterns"))
    edges = materialize(edges.join(fair, "pattern"), "edges")
    trusted = edges.where("seed IS NOT NULL").select(
        "instance", F.col("seed").alias("kind"), F.lit(1.0).alias("trust")
    ).distinct()
    found = None
    for _ in range(ROUNDS):
        scores = (
            edges.join(trusted, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("trust").alias("support"), F.max("n").alias("n"))
            .withColumn("trust", F.col("support") / (F.col("n") + 1))
            .where((F.col("support") >= SUPPORT) & (F.col("trust") >= CONFIDENCE))
        )
        scores = scores.select("pattern", "kind", "trust")
        scores = broadcast_if_small(*materialize_sized(scores, "scores"))
        found = (
            edges.where("seed IS NULL")
            .join(scores, "pattern")
            .groupBy("instance")
            .agg(F.max(F.struct("trust", "kind")).alias("best"))
            .select("instance", "best.kind", "best.trust")
        )
        found = materialize(found, "found")
        trusted = edges.where("seed IS NOT NULL").select(
            "instance", F.col("seed").alias("kind"), F.lit(1.0).alias("trust")
        ).distinct().unionByName(found)
    # An instance counts where one of the good patterns stands before it.
    return (
        places.where("seed IS NULL")
        .join(scores, "pattern")
        .groupBy("_id", "_key", "start", "end")
        .agg(F.max(F.struct("trust", "kind")).alias("best"))
        .select("_id", "_key", "start", "best.kind", "end")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of each span in order, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":",
                F.element_at(names, s["kind"] + 1),
                s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Finds identifiers in every text, by pattern and by context.

    Returns one row per input row: doc_id; n_email, n_ip, n_card, n_phone, how many base
    spans the published patterns give; ``base`` and ``spans``, the base spans and all
    spans as arrays of (start, kind, end) by start and kind, in code points with the end
    exclusive. Added spans lie outside base ones, after words that almost always come
    before identifiers of one kind; base spans always stay.

    Texts are read once. What leaves that pass is spans and tokens with a digit or an at
    sign, with a few words before them. Null and empty texts have no spans. Rows are
    told apart by id and text, so repeated rows get the same spans, and a null id is
    an id of its own. Other columns are ignored.
    """
    rows = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    gates = {k: F.col("text").rlike(NEEDS[k]) for k in KINDS}
    patterns = {f"_{k}": (PATTERNS[k], gates[k]) for k in KINDS}
    patterns["_token"] = (TOKEN, F.col("text").rlike("[0-9@]"))
    scanned = _with_matches(rows.withColumn("_key", F.xxhash64("text")), patterns)
    base = F.concat(*[_base(k, n) for n, k in enumerate(KINDS)])
    scanned = scanned.withColumn("base", F.array_sort(base))
    scanned = scanned.withColumn("tokens", _tokens()).select("_id", "_key", "base", "tokens")
    scanned = materialize(scanned, "scanned")
    added = _bootstrap(scanned).groupBy("_id", "_key").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("added")
    )
    thin = F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = scanned.select("_id", "_key", thin.cast(
        "array<struct<start:int,kind:int,end:int>>"
    ).alias("base")).join(added, ["_id", "_key"], "left")

    def count(number):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return joined.select(
        given_id("_id").alias("doc_id"),
        *counts,
        "base",
        F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"),
    )


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
