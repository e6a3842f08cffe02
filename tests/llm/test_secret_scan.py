"""The secret scan against the published patterns and a plain count of tokens."""

import hashlib
import random
import re
import string
from collections import Counter

import pytest

from stratacast.llm import secret_scan
from stratacast.llm import queries as corpus

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
RANDOM = "q7Zx0Bv9Kd3Lm8Tn2Rw5Yc"
TEXTS = [
    "password = hunter22, Token: 'abc', passwd=\"s3cr3t!\" secret:x.y-z/w+1=",
    "password=token: abcdefgh",  # the first match takes the name of the second
    "tokentoken==abcdef api_key:abcdef apikey : abcdef API_KEY= abcdef api__key=abcdef",
    "paſſword=abcdef toKen=abcdef",  # letters of other scripts are not these letters
    "AKIA" + "A1" * 8 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "C" * 20 + "z AKIA",
    "0" * 24 + " " + "a" * 23 + " " + "deadbeef" * 5 + "g" + "0123456789abcdef" * 4,
    "héé 😀 " + "f" * 30 + " key " + RANDOM,
    f"a {RANDOM} b {RANDOM}== c token={RANDOM} d",
    "550e8400-e29b-41d4-a716-446655440000 9F86D081884C7D659A2FEAA0C55AD015 2024-01-31-12345678",
    "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU= customer_orders_2024_partition_17",
    "ComputeInstanceGroupManager2 12345678901234567890123 rererendanheereredthanwhtion",
    "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=5000)),
]


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [
        (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20
    ]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans_are_those_of_the_patterns(awkward, monkeypatch):
    frame, rows = awkward(TEXTS)
    monkeypatch.setattr(secret_scan, "table", lambda *a: frame)
    query = corpus.QUERIES["op11_secret_scan"]
    got = query(frame.sparkSession, "").collect()
    want = []
    for id, text in rows:
        base = plain_base(text or "")
        n = Counter(k for _, k, _ in base)
        digest = hashlib.sha256(listed(base).encode()).hexdigest()
        want.append((id, n[0], n[1], n[2], digest))
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    for r in got:
        text = dict(rows)[r["doc_id"]] or ""
        spans = r["spans"].split(",") if r["spans"] else []
        base = listed(plain_base(text)).split(",") if plain_base(text) else []
        assert [s for s in spans if not s.startswith("random")] == base


def added(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secret_scan.secrets(frame, secret_scan.public_vocabulary()).first()["spans"]
    return [text[s["start"] : s["end"]] for s in spans if s["kind"] == 3]


def test_random_strings_are_added_outside_of_base_spans(spark):
    assert added(spark, TEXTS[6]) == [RANDOM]
    assert added(spark, TEXTS[7]) == [RANDOM, RANDOM + "=="]
    assert added(spark, TEXTS[11]) == [TEXTS[11]]


@pytest.mark.parametrize("text", TEXTS[8:11])
def test_digests_identifiers_and_names_are_not_added(spark, text):
    assert added(spark, text) == []


def test_ratio_is_characters_per_token():
    import tiktoken

    vocabulary = secret_scan.Vocabulary(*secret_scan.public_vocabulary())
    assert isinstance(vocabulary.encoding, tiktoken.Encoding)
    n = len(vocabulary.encoding.encode_ordinary(RANDOM))
    assert vocabulary.ratio(RANDOM) == len(RANDOM) / n
    long = RANDOM * 100
    cut = [long[i : i + secret_scan.STRETCH] for i in range(0, len(long), secret_scan.STRETCH)]
    assert vocabulary.ratio(long) == len(long) / sum(
        len(vocabulary.encoding.encode_ordinary(c)) for c in cut
    )


def test_random_strings_are_told_from_names():
    rng = random.Random(7)
    vocabulary = secret_scan.Vocabulary(*secret_scan.public_vocabulary())
    letters = string.ascii_letters + string.digits
    strings = ["".join(rng.choices(letters, k=rng.randint(20, 64))) for _ in range(500)]
    assert sum(map(vocabulary.is_random, strings)) >= 490
    words = "load store commit page index reader writer cluster value default".split()
    joins = [
        rng.choice("-_/").join([*rng.choices(words, k=4), str(rng.randint(0, 10**6))])
        for _ in range(500)
    ]
    assert not any(map(vocabulary.is_random, joins))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    found = secret_scan.secrets(frame, secret_scan.public_vocabulary())
    assert found.collect() == [] and found.columns[0] == "doc_id"
