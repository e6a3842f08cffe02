"""Each operator against a brute-force version, on awkward rows as well as plain ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratacast.llm import (
    exact_dedup,
    jaccard_join,
    mixing,
    packing,
    personal_data,
    revisits,
    sharding,
    substring_dedup,
    topk_search,
    toxicity,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 97}x{i}" for i in range(30_000))
BASE = [f"term{i}" for i in range(60)]
TEXTS = [
    None,
    "",
    " \t\n",
    "one two",
    "one  two",
    "One two",
    " ".join(BASE),
    " ".join(BASE),
    " ".join([*BASE[:30], "changed", *BASE[31:]]),
    "intro " + " ".join(BASE[5:25]) + " outro",
    "naïve café 😀 " * 9,
    LONG,
    LONG + " tail",
    "mail me at a.b@c.example.org or +1 (415) 555-0100, from 10.0.0.255 or 10.0.0.256",
    "card 4539 1488 0343 6467 and 4539148803436468, 1.2.3.4.5.6.7.8 a@b.c_d@e.f",
]


def rows_of(spark, texts=TEXTS, extra=True):
    rows = [(i, t, None if i % 3 == 0 else f"src{i % 2}", "en", i, -1) for i, t in enumerate(texts)]
    if extra:
        rows += [(None, "one two", "src0", None, None, 1), rows[6], rows[6]]
    names = "doc_id long, text string, source string, lang string, n_chars long, score int"
    return spark.createDataFrame(rows, names), [(r[0], r[1]) for r in rows]


@pytest.fixture
def docs(spark):
    return rows_of(spark)


@pytest.fixture
def nothing(spark):
    return rows_of(spark)[0].limit(0)


def ids(values):
    return [v for v in values if v is not None]


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (97, 101)])
def test_equal_texts_are_grouped_even_if_fingerprints_collide(docs, primes, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK_CHARS", 500)
    frame, rows = docs
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = Counter(
        (i, min(ids(g)), len(g), i == min(ids(g)), hashlib.sha256(t.encode()).hexdigest())
        for t, g in groups.items()
        for i in g
    )
    assert Counter(map(tuple, exact_dedup.exact_duplicates(frame, primes=primes).collect())) == want


def test_packed_ids_are_those_of_the_tokenizer(docs):
    from tokenizers import Tokenizer

    frame, rows = docs
    files = packing.public_tokenizer()
    whole = Tokenizer.from_file(files[0])
    want = Counter()
    for i, t in rows:
        own = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(own), 2048):
            part = own[k : k + 2048]
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            want[(i, k, len(part), crc, len(own))] += 1
    packed = packing.pack_documents(frame, files).collect()
    assert Counter(tuple(r)[:5] for r in packed) == want
    held = defaultdict(list)
    for r in packed:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_special_tokens_and_long_words_take_the_tokenizer(spark):
    encode = packing.Encoder(*packing.public_tokenizer())
    assert not encode._plain("a <|endoftext|> b")
    assert not encode._plain("a" * 5000)
    assert encode("<|endoftext|>") == (50256).to_bytes(4, "little")


def test_sequences_hold_the_ids(spark):
    frame, _ = rows_of(spark, extra=False)
    files = packing.public_tokenizer()
    packed = packing.pack_documents(frame, files).cache()
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(frame, packed, files).collect()}
    for r in packed.collect():
        part = made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r["ids_crc32"]


def test_histogram_packs_everything_once():
    histogram = {2048: 3, 1500: 40, 700: 55, 548: 40, 3: 1000, 1: 7}
    used = Counter()
    for count, slots in packing.pack_histogram(histogram, 2048):
        assert sum(length * times for length, times in slots) <= 2048
        for length, times in slots:
            used[length] += count * times
    assert used == histogram


def test_scores_are_exact_with_ties_and_bad_vectors(spark):
    rows = [(i, [float((i * k) % 7 - 3) / 8 for k in range(1, 9)]) for i in range(60)]
    rows += [(100, rows[1][1]), (100, rows[1][1]), (200, None), (300, [1.0, None] + [0.0] * 6)]
    rows += [(400, [float("nan")] * 8), (500, [1.0]), (None, rows[2][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = {
        (i, tuple(int(1024 * x // 1) for x in v)) for i, v in rows
        if i is not None and v and all(x is not None and x == x for x in v)
    }
    want = set()
    for q, a in good:
        if q % 20 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q and len(a) == len(b)
            )
            want |= {(q, k, c, -s) for k, (s, c) in enumerate(scored[:10], 1)}
    found = topk_search.top_products(frame, frame.where("vec_id % 20 = 0"))
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_large_components_keep_their_order(spark):
    rows = [(0, [1.0, 0.0]), (1, [40000.0, 0.0]), (2, [50000.0, 0.0]), (3, [2.0**40, 2.0**52])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.top_products(frame, frame.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [
        (3, 2**60),
        (2, 52428800000),
        (1, 41943040000),
    ]
    with pytest.raises(Exception, match="does not fit a long"):
        topk_search.top_products(frame, frame.where("vec_id = 3")).collect()


def test_bounds_hold_for_large_and_even_vectors():
    import numpy as np

    rng = np.random.default_rng(4)
    for size in (2.0**24, 2.0**28):
        q = np.floor(size + rng.normal(size=(8, 32)))
        c = np.floor(size + rng.normal(size=(400, 32)))
        i, j, s = topk_search.best_of_block(np.arange(8) + 5000, q, np.arange(400), c, 10)
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
        for k in range(8):
            want = sorted(range(400), key=lambda n: (-exact[k][n], n))[:10]
            assert j[i == 5000 + k].tolist() == want
            assert s[i == 5000 + k].tolist() == [exact[k][n] for n in want]


def test_bounds_prune_and_never_cut_a_hit():
    import numpy as np

    rng = np.random.default_rng(3)
    q, c = np.floor(rng.normal(size=(20, 64)) * 300), np.floor(rng.normal(size=(900, 64)) * 300)
    for level in (1, 4, 16):
        bound = topk_search.statistics(q, level) @ topk_search.statistics(c, level).T
        assert (bound + 1e-3 >= q @ c.T).all()
    i, j, s = topk_search.best_of_block(np.arange(20) + 5000, q, np.arange(900), c, 10)
    for k in range(20):
        assert sorted(s[i == 5000 + k])[::-1] == sorted((q[k] @ c.T).astype(int))[::-1][:10]


def record(i, url, at, kind="revisit", status=None, digest=None, **headers):
    status = status or (200 if kind == "response" else 304)
    named = {k.replace("_", "-"): v for k, v in headers.items()}
    return (i, url, at, kind, status, named, digest)


def test_records_without_a_url_meet_nothing(spark):
    rows = [
        record(2 * k + n, url, 10 * n, ("response", "revisit")[n], etag='"1"')
        for k, url in enumerate(["", " ", "http://", "#top", None])
        for n in (0, 1)
    ]
    frame = spark.createDataFrame(
        rows,
        """record_id long, url string, captured_at long, record_type string, status int,
        headers map<string,string>, payload_digest string""",
    )
    found = revisits.resolve_revisits(frame).collect()
    assert {(r["canonical_url"], r["resolution"], r["source_id"]) for r in found} == {
        (None, "full", None),
        (None, "missing", None),
    }


def test_revisits_find_the_latest_earlier_response(spark):
    rows = [
        record(1, "http://www.a.org:80/x/?utm_source=f#t", 10, "response", digest="d1", ETag='"1"',
               Content_Type="text/html", Content_Length="9"),
        record(2, "https://A.org/x", 20, etag='W/"1"', Content_Length="0", Age="5"),
        record(3, "https://a.org/x", 30, "response", digest="d2", ETag='"2"'),
        record(4, "https://a.org/x", 40, ETag='"1"'),
        record(5, "https://a.org/x", 50, digest="d2", Connection="X-Hop", X_Hop="1"),
        record(6, "https://a.org/x", 60),
        record(7, "https://a.org/x", 5, ETag='"1"'),
        record(8, None, 70, ETag='"1"'),
        record(9, "https://a.org/x", 80, status=500),
        record(10, "https://a.org/x", 35, "response", status=404, digest="d3"),
        (11, "https://a.org/x", 90, "revisit", 304, None, "d2"),
    ]
    kind = ("record_id long, url string, captured_at long, record_type string, status int, "
            "headers map<string,string>, payload_digest string")
    found = {
        r["record_id"]: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, kind)).collect()
    }
    assert {i: (r["resolution"], r["source_id"]) for i, r in found.items()} == {
        1: ("full", None), 2: ("resolved", 1), 3: ("full", None), 4: ("changed", None),
        5: ("resolved", 3), 6: ("unverified", None), 7: ("missing", None), 8: ("missing", None),
        9: ("other", None), 10: ("full", None), 11: ("resolved", 3),
    }
    merged = {h["key"]: h["value"] for h in found[2]["headers"]}
    assert merged == {"etag": 'W/"1"', "content-type": "text/html", "content-length": "9", "age": "5"}
    assert found[2]["payload_digest"] == "d1"
    assert "x-hop" not in {h["key"] for h in found[5]["headers"]}


def test_a_page_over_many_tasks_keeps_its_last_response(spark):
    rows = [record(0, "a.org/p", 0, "response", digest="d", ETag="e")]
    rows += [record(i, "a.org/p", i, ETag="e") for i in range(1, 400)]
    kind = ("record_id long, url string, captured_at long, record_type string, status int, "
            "headers map<string,string>, payload_digest string")
    found = revisits.resolve_revisits(spark.createDataFrame(rows, kind))
    assert found.where("resolution = 'resolved' AND source_id = 0").count() == 399


def test_mixing_stays_within_one_block(spark):
    rows = [(i, "a" if i % 4 else ("b" if i % 8 else None)) for i in range(1200)]
    frame = spark.createDataFrame([*rows, (None, "a"), rows[0]], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 3), ("b", 2), ("", 2)], "source string, share long")
    found = mixing.mix(frame, weights, block_docs=5).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(1202))
    assert Counter(r["doc_id"] for r in found) == Counter([*(i for i, _ in rows), None, 0])
    blocks = [(r["source"], r["period"]) for k, r in enumerate(found)
              if k == 0 or (r["source"], r["block"]) != (found[k - 1]["source"], found[k - 1]["block"])]
    shares, seen = {"a": 3, "b": 2, "": 2}, Counter()
    whole = min(sum(1 for s, _ in blocks if s == x) // n for x, n in shares.items())
    for t, (source, period) in enumerate((b for b in blocks if b[1] < whole), 1):
        seen[source] += 1
        assert all(abs(seen[s] - t * n / 7) < 1 for s, n in shares.items())


@pytest.mark.parametrize("group", [60_000, 26])
def test_repeated_windows_go(docs, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP_SUFFIXES", group)
    frame, rows = docs
    last = 1 << 62
    cut = [(last if i is None else i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in cut:
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            first[key] = min(first.get(key, last), i)
    want = Counter()
    for i, w in cut:
        gone = set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < i:
                gone.update(range(p, p + 13))
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want[(None if i == last else i, len(w), len(gone), kept)] += 1
    found = substring_dedup.remove_repeats(frame)
    assert Counter(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_text").collect())) == want


def toxic_corpus(spark, n=600):
    import random

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.expovariate(0.02))}" for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(["vile", "dolt", "oaf"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"))


def test_toxic_words_are_learnt_and_held_out_rows_found(spark):
    frame, labels = toxic_corpus(spark)
    found = toxicity.toxicity(frame, labels).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1
    }
    right = sum((r["doc_id"] % 5 == 0) == (r["predicted"] == 1) for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def plain_words(text):
    return re.findall(r"[0-9a-z]+", text.lower())


def as_hash(*words):
    data = " ".join(words).encode()
    hashes, rows, pairs, _ = toxicity._words(
        np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64)
    )
    return int((pairs if len(words) == 2 else hashes).view(np.int64)[0])


def kneser_ney(rows, folds):
    """p of each class for a word after another, counted in dictionaries."""
    every = {p for _, _, t in rows for p in zip(plain_words(t), plain_words(t)[1:])}
    before_all = Counter(w for _, w in every)
    vocabulary = {w for p in every for w in p}
    size = len(every) + len(vocabulary) + 1

    def discounts(values):
        n = [max(sum(v == c for v in values), 1) for c in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        found = [c - (c + 1) * y * n[c] / n[c - 1] for c in (1, 2, 3)]
        return [0, *(min(max(f, 0.5), c) for c, f in enumerate(found, 1))]

    models = []
    for k in (0, 1):
        pairs = Counter(
            p for r, toxic, t in rows if r in folds and toxic == k
            for p in zip(plain_words(t), plain_words(t)[1:])
        )
        before = Counter(w for _, w in pairs)
        cut, cut_words = discounts(pairs.values()), discounts(before.values())
        total = sum(before.values())
        freed = sum(cut_words[min(v, 3)] for v in before.values()) / total if total else 1.0
        after = defaultdict(list)
        for (h, _), v in pairs.items():
            after[h].append(v)

        def single(w, before=before, cut_words=cut_words, total=total, freed=freed):
            own = (before[w] - cut_words[min(before[w], 3)]) / max(total, 1)
            return own + freed * (before_all[w] + 1) / size

        def both(h, w, pairs=pairs, after=after, cut=cut, single=single):
            if h not in after:
                return single(w)
            whole = sum(after[h])
            rest = max(sum(cut[min(v, 3)] for v in after[h]) / whole, 1e-3)
            return (pairs[h, w] - cut[min(pairs[h, w], 3)]) / whole + rest * single(w)

        models.append((single, both))
    return vocabulary, every, models


def awkward_training(spark):
    frame, labels = toxic_corpus(spark, 90)
    label = {r[0]: r[1] for r in labels.where("toxic IS NOT NULL AND doc_id < 60").collect()}
    rows = [(2 * (r["doc_id"] % 2), label.get(r["doc_id"]), r["text"]) for r in frame.collect()]
    rows += [(0, 1, ""), (0, None, "one"), rows[5], rows[5], (2, 0, " ".join(["w1 w2 w3"] * 3000))]
    return rows, spark.createDataFrame(rows, "_r int, toxic int, text string")


@pytest.mark.parametrize("group,held", [(1 << 24, 3_000_000), (5_000, 100)])
def test_models_equal_plain_kneser_ney(spark, monkeypatch, group, held):
    monkeypatch.setattr(toxicity, "GROUP_BYTES", group)
    monkeypatch.setattr(toxicity, "HELD_PAIRS", held)
    rows, training = awkward_training(spark)
    types = toxicity.count_types(training)
    model = toxicity.count_model(types)
    entries = {r["key"]: r["v"] for r in model.entries.collect()}
    for m, folds in enumerate(((0,), (2,), (0, 2))):
        vocabulary, every, models = kneser_ney(rows, folds)
        labelled = {p for _, toxic, t in rows if toxic is not None
                    for p in zip(plain_words(t), plain_words(t)[1:])}
        assert set(entries) == {as_hash(w) for w in vocabulary} | {as_hash(*p) for p in labelled}
        width = len(toxicity.VALUES)
        for k, (single, both) in enumerate(models):
            for w in vocabulary:
                assert entries[as_hash(w)][width * m + k] == pytest.approx(single(w), rel=1e-4)
            assert model.unseen[m][k] == pytest.approx(single("never seen"), rel=1e-6)
            assert sum(map(single, vocabulary)) + model.unseen[m][k] == pytest.approx(1, abs=1e-6)
            for h, w in every:
                own = entries[as_hash(h)][width * m : width * (m + 1)]
                pair = entries.get(as_hash(h, w), [0] * 6)[2 * m + k]
                found = pair * own[4 + k] + own[2 + k] * entries[as_hash(w)][width * m + k]
                assert found == pytest.approx(both(h, w), rel=1e-4)


@pytest.mark.parametrize("part", [1 << 24, 4_000])
def test_features_are_the_plain_ratios(spark, monkeypatch, part):
    monkeypatch.setattr(toxicity, "PART_BYTES", part)
    monkeypatch.setattr(toxicity, "BUCKET_BYTES", part)
    rows, training = awkward_training(spark)
    model = toxicity.count_model(toxicity.count_types(training))
    texts = [r[2] for r in rows[:8]] + ["", "vile w3", "never seen words here", rows[-1][2]]
    asked = spark.createDataFrame(
        [(i, t, (None, 0, 1)[i % 3]) for i, t in enumerate(texts)], "n int, text string, _fold int"
    )
    found = {r["n"]: r for r in toxicity.with_features(asked, model).collect()}
    assert len(found) == len(texts)
    for side, folds_of in (("x", lambda i: (0, 2)), ("y", lambda i: {1: (2,), 2: (0,)}.get(i % 3))):
        for i, t in enumerate(texts):
            folds, words = folds_of(i), plain_words(t)
            if folds is None or not words:
                assert found[i][side + "0"] == 0
                continue
            _, _, ((p0, q0), (p1, q1)) = kneser_ney(rows, folds)
            single = [math.log(p1(w) / p0(w)) for w in words]
            ratio = [single[0]] + [math.log(q1(h, w) / q0(h, w)) for h, w in zip(words, words[1:])]
            mean = sum(max(min(r, 5), -5) for r in ratio) / len(ratio)
            stretch = [sum(single[at : at + 4]) / len(single[at : at + 4])
                       for at in range(max(len(single) - 3, 1))]
            tail = sum(max(s - 3, 0) for s in single) / len(single)
            want = [mean, max(stretch), math.log(tail + 1e-4)]
            assert [found[i][f"{side}{k}"] for k in range(3)] == pytest.approx(want, abs=2e-3)


def test_keys_that_share_a_high_half_are_told_apart():
    keys = np.array([5 << 32 | 1, 5 << 32 | 9, 2**64 - 1, 7], np.uint64)
    wide, narrow = (toxicity.WIDTHS[k] for k in ("words", "pairs"))
    values = [[float(k)] * w for k, w in enumerate((wide, wide, narrow, narrow))]
    entries = pa.table({"key": keys.view(np.int64), "v": pa.array(values, pa.list_(pa.float32()))})
    halves = np.array([0, 5, 6, 2**32 - 1], np.uint32)
    asked = pa.table({"_part": [4], "n": [4], "halves": [toxicity._pack_sorted(halves)]})
    answers = toxicity._answered(asked, entries)
    found, held = toxicity._gathered(answers, "words", 2)
    assert found.tolist() == [5 << 32 | 1, 5 << 32 | 9] and held[:, 0, 0].tolist() == [0, 1]
    found, held = toxicity._gathered(answers, "pairs", 2)
    assert found.tolist() == [7, 2**64 - 1] and held[:, 1, 1].tolist() == [3, 2]


def test_both_folds_and_unlabelled_texts_are_counted(spark, monkeypatch):
    found = []
    count = toxicity.count_types
    monkeypatch.setattr(
        toxicity, "count_types", lambda rows, size: found.append(count(rows, size)) or found[0]
    )
    rows = [(i, f"a{i} b{i}") for i in range(60)]
    labels = [(i, int(i % 4 == 0)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    of = {i: zlib.crc32(str(i).encode()) % 3 for i in range(60)}
    pairs = found[0].where("n IS NULL").collect()
    assert Counter(tuple(r[c] for c in toxicity.COUNTS) for r in pairs) == Counter(
        tuple(int((k, r) == (int(i % 4 == 0), of[i])) for r in (0, 2) for k in (1, 0))
        for i in range(40)
        if of[i] != 1
    )
    learnt = sum(of[i] != 1 for i in range(60))
    assert found[0].agg(F.sum("n")).first()[0] == learnt
    assert model.entries.count() == 2 * learnt + sum(of[i] != 1 for i in range(40))
    assert toxicity.score(docs, model).count() == len(rows)


def small_steps(monkeypatch):
    sizes = {"PART_BYTES": 5_000, "GROUP_BYTES": 40_000, "BUCKET_BYTES": 40_000, "HELD_PAIRS": 2_000}
    for name, size in {**sizes, "TEXT_BYTES": 1_000}.items():
        monkeypatch.setattr(toxicity, name, size)


def test_packed_counts_give_the_features_of_the_models(spark, monkeypatch):
    frame, labels = toxic_corpus(spark)
    odd = [(None, "w1 vile"), (7, None), (8, ""), (9, "w1 w2 w3 " * 3000), (9, "w1"), (9, "w1")]
    frame = frame.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    own = toxicity._labelled(frame, labels, "doc_id", "text")
    learnt = own.where(f"_r <> {toxicity.HELD_OUT_REMAINDER}")
    model = toxicity.count_model(toxicity.count_types(learnt))
    want = toxicity.with_features(own.drop("_r"), model).collect()
    small_steps(monkeypatch)
    found, law = toxicity._own_features(own)
    found = found.collect()
    assert law.unseen == model.unseen
    by = [lambda r: (r["_id"], r["_mark"]), toxicity.NAMES]
    assert sorted(map(by[0], found)) == sorted(map(by[0], want))
    want = {by[0](r): r for r in want}
    for r in found:
        assert [r[c] for c in by[1]] == pytest.approx([want[by[0](r)][c] for c in by[1]], abs=1e-9)


def test_counts_stay_packed_and_parts_are_scored_in_rounds(spark, monkeypatch):
    small_steps(monkeypatch)
    written, write = defaultdict(list), toxicity.written_by_python

    def recorded(frame, name):
        written[name].append(write(frame, name))
        return written[name][-1]

    monkeypatch.setattr(toxicity, "written_by_python", recorded)
    frame, labels = toxic_corpus(spark)
    assert toxicity.scored_rows(frame, labels).count() == 600
    scored = [f.count() for f in written.pop("features")]
    assert len(scored) > 1 and sum(scored) == 600 and max(scored) < 400
    # Not a row to each word or pair.
    assert 0 < sum(f.count() for frames in written.values() for f in frames) < 100


def test_toxicity_of_awkward_rows(docs, nothing, spark):
    _, labels = toxic_corpus(spark, 30)
    assert toxicity.toxicity(docs[0], labels).count() == len(docs[1])
    assert toxicity.toxicity(docs[0], labels.limit(0)).count() == len(docs[1])
    assert toxicity.toxicity(nothing, labels).count() == 0


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2)])
def test_the_curve_visits_neighbours(spark, dimensions, bits):
    cells = [f"c{k}" for k in range(dimensions)]
    grid = spark.range(1 << dimensions * bits).select(
        *[F.expr(f"CAST(shiftright(id, {bits * k}) & {(1 << bits) - 1} AS int) AS {c}")
          for k, c in enumerate(cells)]
    )
    path = sorted((r[-1], r[:-1]) for r in map(tuple, sharding.with_curve_index(grid, cells, bits, "at").collect()))
    assert [at for at, _ in path] == list(range(len(path)))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for (_, x), (_, y) in zip(path, path[1:]))


def test_shards_are_even_and_gapless(docs):
    frame, rows = docs
    found = sharding.assign_shards(frame, shards=4).collect()
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("chunk,side", [(128, 8), (2, 1)])
def test_near_duplicates_equal_all_pairs(spark, chunk, side, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_TEXTS", chunk)
    monkeypatch.setattr(jaccard_join, "CHUNKS_A_SIDE", side)
    near = [" ".join([*BASE[:k], "other", *BASE[k + 1 :]]) for k in (0, 1, 2, 58, 59)]
    frame, rows = rows_of(spark, TEXTS + near)
    texts = defaultdict(list)
    for i, t in rows:
        texts[tuple(WORDS.findall(t or ""))].append(i)
    first = {t: min(ids(v)) for t, v in texts.items()}
    sets = {t: {t[k : k + 5] for k in range(len(t) - 4)} for t in texts}
    links = defaultdict(set)
    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a != b and both * 5 >= 4 * len(sets[a] | sets[b]) > 0:
                links[a].add(b)

    def reach(t):
        seen, todo = {t}, [t]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        return min(first[b] for b in seen)

    want = Counter(
        (i, reach(t), first[t], len(v), len(links[t])) for t, v in texts.items() for i in v
    )
    assert Counter(map(tuple, jaccard_join.near_duplicates(frame).collect())) == want


def test_the_prefix_shortens_to_the_recall():
    assert jaccard_join.prefix_length(0.8, 24, 8, 0.9999) == 5
    assert jaccard_join.prefix_length(0.8, 24, 8, 0.9) > 5
    with pytest.raises(ValueError):
        jaccard_join.prefix_length(0.1, 2, 8, 0.9999)


BASIC = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def real(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = (int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def basic_spans(text):
    return sorted(
        (m.start(), n, m.end())
        for n, (kind, rx) in enumerate(BASIC.items())
        for m in re.finditer(rx, text or "")
        if real(kind, m.group())
    )


HARD = ["..@x.y", "a@b.c.@d.e", "1 2 3 " * 400, "a" * 20_000, "a.b." * 900 + "@" + "c." * 3,
        "0.0.0.0 00000000001.2.3.255 256.1.1.1", "😀a@b.c +1 (2) 345-678-9012 3", "+" * 50 + "1" * 30]


def test_base_spans_are_those_of_the_published_patterns(spark):
    frame, rows = rows_of(spark, TEXTS + HARD)
    want = Counter((i, tuple(basic_spans(t))) for i, t in rows)
    found = personal_data.personal_data(frame).collect()
    assert Counter((r["doc_id"], tuple(map(tuple, r["base"]))) for r in found) == want
    assert all(set(r["base"]) <= set(r["spans"]) for r in found)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"so you can call me at +1 (415) 555-{i:04d} today") for i in range(12)]
    rows += [(100, "please call me at 555-0199 now"), (101, "order number 555-0199 now")]
    found = personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    added = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.where("doc_id >= 100").collect()}
    assert added == {100: [(18, 3, 26)], 101: []}


def added_spans(spark, rows):
    found = personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    rows = found.where("doc_id >= 1000").collect()
    return {r["doc_id"]: [tuple(s) for s in r["spans"] if s not in r["base"]] for r in rows}


def test_one_label_word_is_a_context(spark):
    rows = [(i, f"tel +1 (415) 555-{i:04d} today") for i in range(30)]
    rows += [(1000, "tel 555-0199"), (1001, "room 12 tel 555-0198 or"), (1002, "order 555-0197")]
    # Beyond one run of matches, and after words that no longer fit into the context.
    rows += [(1003, "a1 " * 300 + "tel 555-0196"), (1004, "x" * 70 + " tel 555-0195")]
    assert added_spans(spark, rows) == {
        1000: [(4, 3, 12)],
        1001: [(12, 3, 20)],
        1002: [],
        1003: [(904, 3, 912)],
        1004: [(75, 3, 83)],
    }


def test_found_instances_support_contexts_without_seeds(spark):
    rows = [(i, f"we alpha +1 (415) 555-{i:04d}") for i in range(300)]
    rows += [(400 + i, f"we alpha 77-{i:02d}") for i in range(15)]
    rows += [(500 + i, f"so beta 77-{i:02d}") for i in range(15)]
    rows += [(1000, "so beta 88-00"), (1001, "so gamma 88-01")]
    assert added_spans(spark, rows) == {1000: [(8, 3, 13)], 1001: []}


def test_empty_tables_give_no_rows(nothing, spark):
    files = packing.public_tokenizer()
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for made in (
        personal_data.personal_data(nothing),
        exact_dedup.exact_duplicates(nothing),
        packing.pack_documents(nothing, files),
        topk_search.top_products(vectors, vectors),
        revisits.resolve_revisits(revisits.captures(pages)),
        mixing.mix(nothing),
        substring_dedup.remove_repeats(nothing),
        sharding.assign_shards(nothing),
        jaccard_join.near_duplicates(nothing),
    ):
        assert made.count() == 0
