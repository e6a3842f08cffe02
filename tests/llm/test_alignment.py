"""Cross-tokenizer alignment against a plain version, token by token."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as public
import sentencepiece
from tokenizers import Tokenizer

from stratacast.llm import alignment
from stratacast.llm import queries as corpus

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    " two  blanks\n\n\tand tabs ",
    "a▁b",  # this mark stands for a blank in B
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve café 日本語 😀 ﬁ１２ \x00 ​ é",
    "x" * 5000,
    "x " + " " * 3000 + "y",
    "The quick brown fox jumps over the lazy dog. The quick brown fox.",
    "﻿mark",
]


def plain(rows):
    a_tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = sentencepiece.SentencePieceProcessor(
        model_file=public.path("piece_bpe_32k.model")
    )
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def tokens(text):
        a = a_tokenizer.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(byte[c] for c in t) for t in a.tokens]
        b, b_bytes = b_tokenizer.encode(text), []
        for i in b:
            piece = b_tokenizer.id_to_piece(i)
            one = len(piece) == 6 and piece.startswith("<0x") and b_tokenizer.is_byte(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if one else piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return [], []
        out = []
        for ids, parts in ((a.ids, a_bytes), (b, b_bytes)):
            at, placed = 0, []
            for i, p in zip(ids, parts):
                placed.append((i, at, at + len(p)))
                at += len(p)
            out.append(placed)
        return out

    aligned, counts = {}, Counter()
    for text in {t for _, t in rows if t}:
        a, b = tokens(text)
        links = [(i, j) for i, s, e in a for j, u, v in b if max(s, u) < min(e, v)]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in ends:
            groups.append(
                "|".join(
                    ",".join(str(i) for i, s, e in side if low <= s and e <= high)
                    for side in (a, b)
                )
            )
            low = high
        aligned[text] = (len(a), len(b), len(groups), links, ";".join(groups))
    for _, text in rows:
        if text:
            counts.update(aligned[text][3])
    highest = defaultdict(int)
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    found = []
    for id, text in rows:
        n_a, n_b, n_groups, links, groups = aligned.get(text or "", (0, 0, 0, [], ""))
        found.append(
            (
                id,
                n_a,
                n_b,
                n_groups,
                len(links),
                sum(counts[x] == highest[x[1]] for x in links),
                sum(counts[x] for x in links),
                hashlib.sha256(groups.encode()).hexdigest() if links else "",
            )
        )
    return found, counts


def test_query_equals_a_plain_alignment(awkward, monkeypatch):
    frame, rows = awkward(TEXTS)
    rows = [r for r in rows if len(r[1] or "") < 9000]
    frame = frame.where("text IS NULL OR length(text) < 9000")
    monkeypatch.setattr(alignment, "table", lambda *a: frame)
    got = corpus.QUERIES["op13_alignment"](frame.sparkSession, "")
    assert got.columns == ["doc_id", *alignment.MEASURES, "groups_sha256"]
    want, _ = plain(rows)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_pairs_hold_the_links_of_all_copies(awkward):
    frame, rows = awkward(TEXTS[:5])
    rows = [r for r in rows if len(r[1] or "") < 9000]
    frame = frame.where("text IS NULL OR length(text) < 9000")
    _, pairs = alignment.align_corpus(frame, alignment.public_pair())
    _, want = plain(rows)
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == dict(want)


def test_a_large_group_of_copies_is_aligned_once(spark, monkeypatch):
    copies = spark.range(20_000).selectExpr("id AS doc_id", "'to be or not to be' AS text")
    found, pairs = alignment.align_corpus(copies, alignment.public_pair())
    measures = found.drop("doc_id", "digest").distinct().collect()
    assert len(measures) == 1 and found.count() == 20_000
    want, counts = plain([(0, "to be or not to be")])
    assert measures[0]["n_links"] == want[0][4]
    assert measures[0]["count_sum"] == 20_000 * want[0][6]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    found, pairs = alignment.align_corpus(frame, alignment.public_pair())
    assert found.count() == 0 and pairs.count() == 0
