"""Repeated passages by prefix-partitioned suffix trees over words."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import given_id, known_id, table, text_of
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

WINDOW_WORDS = 13
# Words of the first prefix of a suffix; see _anchored.
ANCHOR_WORDS = 4
# Suffixes that one subtree's task should hold at most.
GROUP_SUFFIXES = 60_000
# Prefixes of heavy groups grow to these many words.
LONGER_PREFIXES = (8, WINDOW_WORDS)


def _anchored(data, offsets, window):
    """Windows of a group of rows: first word, row, and the anchor they share.

    The anchor of a window is the run of ANCHOR_WORDS words in it with the smallest hash.
    Equal windows have equal anchors, and neighbouring windows mostly share theirs, so
    a window can only recur where its anchor does.
    """
    hashes, begin, end, rows = tokens.words(data, offsets)
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, begin, end, rows
    parts, at = tokens.runs(hashes, rows, ANCHOR_WORDS)
    full = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    full[at] = parts
    least = full[:n].copy()
    for k in range(1, window - ANCHOR_WORDS + 1):
        np.minimum(least, full[k : k + n], out=least)
    starts = np.flatnonzero(rows[:n] == rows[window - 1 :])
    return starts, rows[starts], least[starts].view(np.int64), begin, end, rows


def _fresh(rows, anchors) -> np.ndarray:
    """The first of consecutive windows of a row with the same anchor."""
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (anchors[1:] != anchors[:-1])
    return np.flatnonzero(fresh)


def _anchor_ids(window):
    """(anchor, smallest and largest id) of the documents of a task, already combined."""

    def found(batches):
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            for low, data, offsets in tokens.groups(batch.column("text")):
                _, rows, anchors, *_ = _anchored(data, offsets, window)
                keep = _fresh(rows, anchors)
                if not len(keep):
                    continue
                own, who = anchors[keep], ids[low + rows[keep]]
                order = np.lexsort((who, own))
                own, who = own[order], who[order]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                last = np.r_[first[1:] - 1, len(own) - 1]
                arrays = [pa.array(own[first]), pa.array(who[first]), pa.array(who[last])]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "first", "last"])

    return found


def _anchor_rows(window):
    def found(batches):
        for batch in batches:
            keys = batch.column("_key").to_numpy()
            for low, data, offsets in tokens.groups(batch.column("text")):
                _, rows, anchors, *_ = _anchored(data, offsets, window)
                keep = _fresh(rows, anchors)
                arrays = [pa.array(anchors[keep]), pa.array(keys[low + rows[keep]])]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "_key"])

    return found


def _passages(window):
    """Stretches of consecutive windows that share an anchor which other documents have."""

    def found(batches):
        for batch in batches:
            ids, keys = batch.column("_id").to_numpy(), batch.column("_key").to_numpy()
            lists = batch.column("anchors")
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            for low, data, offsets in tokens.groups(batch.column("text")):
                n = len(offsets) - 1
                starts, rows, anchors, begin, end, all_rows = _anchored(data, offsets, window)
                if not len(starts):
                    continue
                owners = np.repeat(np.arange(n), np.diff(ends[low : low + n + 1]))
                salt = tokens.mix(np.arange(1, n + 1).astype(np.uint64)).view(np.int64)
                wanted = flat[ends[low] : ends[low + n]] ^ salt[owners]
                hit = np.flatnonzero(np.isin(anchors ^ salt[rows], wanted))
                if not len(hit):
                    continue
                s, r, a = starts[hit], rows[hit], anchors[hit]
                new = np.r_[True, (s[1:] != s[:-1] + 1) | (r[1:] != r[:-1]) | (a[1:] != a[:-1])]
                lo = np.flatnonzero(new)
                hi = np.r_[lo[1:] - 1, len(s) - 1]
                raw = data.tobytes()
                word0 = tokens.bounds(all_rows, n)
                content = [
                    b" ".join(raw[begin[s[x]] : end[s[y] + window - 1]].split()).decode()
                    for x, y in zip(lo, hi)
                ]
                arrays = [
                    pa.array(ids[low + r[lo]]),
                    pa.array(keys[low + r[lo]]),
                    pa.array(s[lo] - word0[r[lo]]),
                    pa.array(a[lo]),
                    pa.array(content, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["_id", "_key", "pos", "anchor", "content"]
                )

    return found


def subtree(contents, firsts, lasts, window: int) -> list[list[int | None]]:
    """For each window of each content: the smallest id that has it, if several have.

    The suffixes that begin at the windows are sorted, which is the order of the leaves
    of their suffix tree. Neighbours whose common prefix has ``window`` words or more hang
    below one internal node of that depth: a repeat. Its smallest and largest ids tell
    whether more than one document has it.
    """
    cut = [c.split(" ") for c in contents]
    suffixes = [
        (" ".join(words[p : p + window]), c, p)
        for c, words in enumerate(cut)
        for p in range(len(words) - window + 1)
    ]
    suffixes.sort()
    found: list[list[int | None]] = [[None] * (len(w) - window + 1) for w in cut]
    low = 0
    while low < len(suffixes):
        high = low + 1
        # Suffixes are cut at ``window`` words: equal ones share a node at that depth.
        while high < len(suffixes) and suffixes[high][0] == suffixes[low][0]:
            high += 1
        node = [c for _, c, _ in suffixes[low:high]]
        first = min(firsts[c] for c in node)
        if first < max(lasts[c] for c in node):
            for _, c, p in suffixes[low:high]:
                found[c][p] = first
        low = high
    return found


def _digest():
    """Stands for a content in joins: 128 bits of SHA-256, a sixth of a content's size."""
    return F.substring(F.unhex(F.sha2("content", 256)), 1, 16)


def _grow_trees(leaves: DataFrame, window: int) -> DataFrame:
    """``leaves`` (content, first, last, _group) to (digest, firsts), repeats only."""

    def tree(frame: pd.DataFrame) -> pd.DataFrame:
        firsts = subtree(
            frame["content"].tolist(), frame["first"].tolist(), frame["last"].tolist(), window
        )
        made = pd.DataFrame({"content": frame["content"], "firsts": firsts})
        return made[[any(f is not None for f in own) for own in firsts]]

    grown = leaves.select("_group", "content", "first", "last").groupBy("_group")
    found = grown.applyInPandas(tree, "content string, firsts array<long>")
    return found.select(_digest().alias("digest"), "firsts")


def _grouped(n_leaves: int, window: int):
    return max(1, -(-n_leaves * (window // 2) // GROUP_SUFFIXES))


def _windows_of(passages: DataFrame, window: int) -> DataFrame:
    """One row per window of a passage; ``at`` is its place in the passage."""
    words = F.split("content", " ")
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.array_join(F.slice(words, i + 1, F.lit(window)), " "),
    )
    others = [c for c in passages.columns if c != "content"]
    return passages.select(*others, F.posexplode(each).alias("at", "content"))


def _resolved(passages: DataFrame, window: int) -> DataFrame:
    """Stretches to remove from passages (…, pos, anchor, content).

    Returns _id, _key and, for each stretch in order, where its first and its last window
    start: windows that overlap or touch are one stretch, so a copy is a single one.
    """
    leaves = passages.groupBy("anchor", "content").agg(
        F.min("_id").alias("first"), F.max("_id").alias("last")
    )
    leaves = materialize(leaves, "leaves")
    limit = GROUP_SUFFIXES // window
    heavy = leaves.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    heavy = broadcast_if_small(*materialize_sized(heavy.select("anchor"), "heavy"))
    light = leaves.join(heavy, "anchor", "left_anti")
    buckets = _grouped(leaves.count(), window)
    light = light.withColumn("_group", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    known = _grow_trees(light, window)
    # Groups of heavy anchors: longer prefixes of the single suffixes, until none is heavy.
    pending = _windows_of(leaves.join(heavy, "anchor"), window)
    pending = pending.groupBy("anchor", "content").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    pending = materialize(pending, "pending")
    single = None
    for length in LONGER_PREFIXES:
        prefix = F.xxhash64("anchor", F.substring_index("content", " ", length))
        pending = pending.withColumn("_prefix", prefix)
        if length < window:
            many = pending.groupBy("_prefix").agg(F.count("*").alias("n")).where(
                F.col("n") > GROUP_SUFFIXES
            )
            many = broadcast_if_small(*materialize_sized(many.select("_prefix"), "many"))
            settled = pending.join(many, "_prefix", "left_anti")
            later = pending.join(many, "_prefix", "left_semi").drop("_prefix")
        else:
            settled, later = pending, None
        groups = _grouped(pending.count(), 2)
        settled = settled.withColumn("_group", F.pmod("_prefix", F.lit(groups))).drop("_prefix")
        trees = _grow_trees(settled, window)
        single = trees if single is None else single.unionByName(trees)
        pending = later
    own = passages.join(heavy, "anchor", "left_anti")
    own = own.select("_id", "_key", "pos", _digest().alias("digest")).join(known, "digest")
    starts = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("firsts") - 1),
            lambda i: F.when(
                F.element_at("firsts", i + 1) < F.col("_id"), (F.col("pos") + i).cast("int")
            ),
        ),
        lambda p: p.isNotNull(),
    )
    from_light = own.select("_id", "_key", starts.alias("starts"))
    split = _windows_of(passages.join(heavy, "anchor"), window)
    split = split.select("_id", "_key", "pos", "at", _digest().alias("digest"))
    from_heavy = split.join(single, "digest").where(F.col("firsts")[0] < F.col("_id")).select(
        "_id", "_key", F.array((F.col("pos") + F.col("at")).cast("int")).alias("starts")
    )
    both = from_light.where(F.size("starts") > 0).unionByName(from_heavy)
    all_ = F.array_sort(F.flatten(F.collect_list("starts")))
    sorted_ = both.groupBy("_id", "_key").agg(all_.alias("_all"))
    firsts = F.filter("_all", lambda x, i: (i == 0) | (x - F.get("_all", i - 1) > window))
    lasts = F.filter(
        "_all",
        lambda x, i: (i == F.size("_all") - 1) | (F.get("_all", i + 1) - x > window),
    )
    return sorted_.select("_id", "_key", firsts.alias("starts"), lasts.alias("lasts"))


def _kept(window):
    """Words that stay: their text, and how many there were and went."""

    def made(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            stretches = zip(batch.column("starts").to_pylist(), batch.column("lasts").to_pylist())
            out: list[list] = [[], [], []]
            for text, (starts, lasts) in zip(texts, stretches):
                own = text.encode().split()
                gone = np.zeros(len(own) + 1, np.int32)
                if starts:
                    # Stretches do not touch, so no place is named twice.
                    gone[starts] += 1
                    gone[np.array(lasts) + window] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                left = [w for w, s in zip(own, stay) if s] if starts else own
                for c, v in zip(out, (b" ".join(left).decode(), len(own), len(own) - len(left))):
                    c.append(v)
            rest = batch.drop_columns(["text", "starts", "lasts"])
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, *[pa.array(c, k) for c, k in zip(out, kinds)]],
                [*rest.schema.names, "kept_text", "n_words", "n_removed"],
            )

    return made


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """Removes words covered by a window that also starts in a document with a smaller id.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``,
    the words that stay joined by one space. A window is ``window`` consecutive words of a
    document; words are what white space `[\\x20\\x09-\\x0D]+` separates. Windows are judged
    on the input, not on what is left.

    Anchors that only one document has rule out all windows around them, in two passes of
    hashes that are combined before they are shuffled. What remains are passages; equal
    passages become one leaf, so a passage that a third of all documents share is one row.
    Leaves are dealt out by prefix, several prefixes to a group, and prefixes with too many
    leaves are lengthened until they fit. Words are compared as text.

    Null and empty texts have no words. Null ids sort last, and rows that share an id are
    one document, so they do not remove each other's words. Other columns are ignored.
    """
    source = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    source = source.select("_id", F.xxhash64("_id", "text").alias("_key"), "text")
    anchors = source.select("_id", "text").mapInArrow(
        _anchor_ids(window), "anchor long, first long, last long"
    )
    spread = anchors.groupBy("anchor").agg(F.min("first").alias("f"), F.max("last").alias("l"))
    repeated = spread.where("f < l").select("anchor")
    repeated = broadcast_if_small(*materialize_sized(repeated, "anchors"))
    # Texts that share a key would only be looked at more closely.
    own = source.select("_key", "text").mapInArrow(_anchor_rows(window), "anchor long, _key long")
    lists = own.join(repeated, "anchor").groupBy("_key").agg(
        F.collect_set("anchor").alias("anchors")
    )
    lists = broadcast_if_small(*_sized(lists, "lists"))
    passages = source.join(lists, "_key").select("_id", "_key", "text", "anchors").mapInArrow(
        _passages(window), "_id long, _key long, pos long, anchor long, content string"
    )
    removed = _resolved(materialize(passages, "passages"), window)
    removed = broadcast_if_small(*_sized(removed, "removed"))
    return source.join(removed, ["_id", "_key"], "left").select(
        "_id", "text", "starts", "lasts"
    ).mapInArrow(
        _kept(window), "_id long, kept_text string, n_words long, n_removed long"
    ).withColumn("doc_id", given_id("_id")).drop("_id")


def _sized(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A written frame of ids and arrays of integers, and its size in bytes at most."""
    arrays = [F.size(n) * 8 + 48 for n, t in rows.dtypes if t.startswith("array")]
    written = materialize(rows, name)
    size = written.agg(F.sum(sum(arrays))).first()[0]
    return written, size or 0


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words
), texts AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS t FROM windows
), firsts AS (
  SELECT doc_id, p, min(doc_id) OVER (PARTITION BY t) AS f FROM texts
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS g
  FROM (SELECT doc_id, unnest(range(p, p + 13)) AS q FROM firsts WHERE f < doc_id) GROUP BY doc_id
), numbered AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM words
), kept AS (
  SELECT n.doc_id, string_agg(n.w[n.q], ' ' ORDER BY n.q) AS t, count(*) AS n
  FROM numbered n LEFT JOIN gone USING (doc_id)
  WHERE g IS NULL OR NOT list_contains(g, n.q) GROUP BY n.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
