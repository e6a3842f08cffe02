"""Secrets: published patterns, and random strings that a tokenizer's vocabulary betrays."""

from __future__ import annotations

import re
from base64 import b64decode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm.common import given_id, known_id, table, text_of, written_by_python

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]
# Letters of a name count in either case, in ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST = 6
# A match takes the whole run of its class, so asking for the least length at once finds the
# same ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Strings of this many characters that hold letters and digits are tested for randomness.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# Characters per token: prose has 3 to 5, names joined of words over 2.5, random letters and
# digits 1.3 to 2.
RANDOM_RATIO = 2.2
# Tokens are counted in stretches of so many characters: the tokenizer's time grows with the
# square of a word's length.
STRETCH = 512
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
ONE_CASE_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
INTEGRITY = re.compile(r"sha(?:1|224|256|384|512)[-_][A-Za-z0-9+/_-]+={0,2}")
# Words and numbers that are joined: order-2024-part-17, snake_case_v2, CamelCaseName3.
NAME = re.compile(r"(?:[A-Za-z]+[0-9]*|[0-9]+)(?:[+/_-]+(?:[A-Za-z]+[0-9]*|[0-9]+))*[+/_-]*=*")

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def is_known(string: str) -> bool:
    """Whether a string is written like a digest, a UUID or a name, which are not secrets."""
    if ONE_CASE_HEX.fullmatch(string):
        return len(string) in DIGEST_LENGTHS or string.isdigit()
    return any(p.fullmatch(string) for p in (UUID, INTEGRITY, NAME))


class Vocabulary:
    """Counts tokens under a tiktoken vocabulary, from its file of ranks and its pattern."""

    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def ratio(self, string: str) -> float:
        """Characters per token; a long string is counted in stretches."""
        stretches = (string[i : i + STRETCH] for i in range(0, len(string), STRETCH))
        return len(string) / sum(len(self.encoding.encode_ordinary(s)) for s in stretches)

    def is_random(self, string: str) -> bool:
        mixed = any(c.isdigit() for c in string) and any(c.isalpha() for c in string)
        return mixed and not is_known(string) and self.ratio(string) <= RANDOM_RATIO


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the published patterns, by start and kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, base: list, vocabulary: Vocabulary) -> list[tuple[int, int, int]]:
    """(start, kind, end) of random strings that no base span touches."""
    found, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        # Base spans by start: ``reach`` is the furthest end of those that begin before.
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start and vocabulary.is_random(m.group()):
            found.append((start, 3, end))
    return found


def _scan(ranks_file: str, pattern: str):
    kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))

    def array(spans):
        return pa.array(
            [[dict(zip(("start", "kind", "end"), s)) for s in row] for row in spans], kind
        )

    def scan(batches):
        vocabulary = Vocabulary(ranks_file, pattern)
        for batch in batches:
            base, added = [], []
            for text in batch.column("text"):
                text = text.as_py()
                base.append(base_spans(text))
                added.append(random_spans(text, base[-1], vocabulary))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), array(base), array(added)], ["_id", "base", "added"]
            )

    return scan


def secrets(
    docs: DataFrame, vocabulary: tuple[str, str], id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Finds secrets in every whole text, by pattern and by how badly a tokenizer fits them.

    ``vocabulary`` is a tiktoken file of ranks and its pattern. Returns one row per input
    row: doc_id; n_assign, n_access, n_hex, how many base spans the published patterns give;
    ``base`` and ``spans``, the base spans and all spans as arrays of (start, kind, end) by
    start and kind, in code points with the end exclusive; kinds count as in KINDS. Added
    spans are strings of 20 characters or more with letters and digits, of at most 2.2
    characters per token, that are not written like a digest, a UUID, an integrity value or a
    name of words and numbers; none touches a base span.

    Texts are read once and not shuffled. A text of any length is searched whole, and a
    string of any length tested whole. Null and empty texts have no spans, null ids stay
    null, repeated rows are scanned each, ties do not arise, other columns are ignored,
    and an empty table gives no rows.
    """
    rows = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    scanned = rows.mapInArrow(_scan(*vocabulary), f"_id long, base {_SPANS}, added {_SPANS}")
    scanned = written_by_python(scanned, "secrets")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)]
    return scanned.select(
        given_id("_id").alias("doc_id"),
        *counts,
        "base",
        F.array_sort(F.concat("base", "added")).alias("spans"),
    )


def _listed(spans: str) -> Column:
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


def public_vocabulary() -> tuple[str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"), public_vocabulary()).select(
        "doc_id",
        *[f"n_{k}" for k in BASE_KINDS],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )
