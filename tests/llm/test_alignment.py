"""Cross-tokenizer alignment against groups and counts worked out in plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from edge import edge_docs, edge_rows, empty_docs
from lodestar.llm import align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain_tokens():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = SentencePieceProcessor(model_file=B)
    printable = {c: i for i, c in _byte_letters()}

    def a(text):
        e = t.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(printable[c] for c in t.id_to_token(i))) for i in e.ids]

    def b(text):
        out = []
        for i in s.encode(text):
            piece = s.id_to_piece(i)
            out.append((i, bytes([int(piece[3:5], 16)]) if s.is_byte(i) else piece.replace("▁", " ").encode()))
        return out

    assert ByteLevel()
    return a, b


def _byte_letters():
    extra = 0
    for c in range(256):
        if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255:
            yield c, chr(c)
        else:
            yield c, chr(256 + extra)
            extra += 1


def plain(texts):
    enc_a, enc_b = plain_tokens()
    docs = []
    for text in texts:
        a, b = (enc_a(text), enc_b(text)) if text else ([], [])
        want = (" " + text).encode() if text else b""
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append(([], [], []))
            continue
        groups, x, y, at_a, at_b = [([], [])], 0, 0, 0, 0
        while x < len(a) or y < len(b):
            if at_a <= at_b:
                groups[-1][0].append(a[x][0])
                at_a += len(a[x][1])
                x += 1
            else:
                groups[-1][1].append(b[y][0])
                at_b += len(b[y][1])
                y += 1
            if at_a == at_b:
                groups.append(([], []))
        docs.append((a, b, groups[:-1]))
    links = [Counter((i, j) for ga, gb in g for i in ga for j in gb) for _, _, g in docs]
    count = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = []
    for (a, b, g), c in zip(docs, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((len(a), len(b), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "the the the the cat",
    " leading and  double   spaces \n\n new lines\t",
    "été 漢字 😀😀 ́ <s>[INST]\\ <|endoftext|> </s> <unk>",
    "▁ is not a space",
    "\x00\x0b\r\n",
    "",
    None,
    "x",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40,
    "supercalifragilisticexpialidocious 1234567890" * 30,
    "the the the the cat",
]
COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("table_pairs, piece", [(1_000_000, 8192), (30, 3), (0, 17)])
def test_alignment_equals_plain(spark, table_pairs, piece):
    """With all, some and none of the pairs in the table sent to the tasks, and with pieces of any size."""
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r["row"]["doc_id"]: tuple(r[c] for c in COLS) for r in align.token_alignment(df, A, B, table_pairs=table_pairs, piece=piece).collect()}
    assert got == dict(enumerate(plain(TEXTS)))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 10_000])
def test_pieces_of_any_size_give_the_same_groups(piece):
    rng = random.Random(piece)
    for n in (0, 1, 5, 300):
        shared = sorted(rng.sample(range(1, 4000), n))
        ends = [np.array(sorted({*shared, *(rng.randrange(1, 4000) for _ in range(k * n)), *([4000] if n else [])})) for k in (1, 3)]
        ga, gb = align.overlaps(ends[0].astype(np.int64), ends[1].astype(np.int64), piece)
        both = sorted({*ends[0].tolist()} & {*ends[1].tolist()})
        assert [ends[0][g - 1] for g in ga[1:]] == both == [ends[1][g - 1] for g in gb[1:]]
        i, j = align.cut_path(ends[0], ends[1], piece)
        work = np.diff(i) + np.diff(j)
        assert (work <= piece + 1).all() and work.sum() == len(ends[0]) + len(ends[1])


def test_no_shared_end_over_many_pieces():
    a, b = np.arange(1, 2000, 2), np.arange(2, 2000, 2)
    a = np.append(a, 2000)
    b = np.append(b, 2000)
    ga, gb = align.overlaps(a, b, 16)
    assert ga.tolist() == [0, len(a)] and gb.tolist() == [0, len(b)]


def test_odd_rows(spark):
    rows = edge_rows()
    got = align.token_alignment(edge_docs(spark), A, B).collect()
    want = plain([r[1] for r in rows])
    assert sorted(tuple(r[c] for c in COLS) for r in got) == sorted(want)
    assert "text" not in got[0]["row"].asDict() and got[0]["row"]["id"] == "x"
    assert align.token_alignment(empty_docs(spark), A, B).count() == 0


def test_links_of_wide_groups_are_counted_before_they_meet():
    """A group of 3,000 by 3,000 tokens of few ids makes few pairs."""
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 5, 3000), rng.integers(0, 7, 3000)
    of, key, n = align._pairs(np.array([0, 3000]), np.array([0, 3000]), x, y, 100, np.zeros(1, np.int64), at=8)
    want = Counter(int(i) * 100 + int(j) for i in x for j in y)
    assert dict(zip(key.tolist(), n.tolist())) == want and (of == 0).all()


def test_segments_give_the_ids_of_whole_texts(spark):
    """Texts put together at random from awkward parts, and all of a table's, by segments and whole."""
    from lodestar.sources.tables import read_table

    rng = random.Random(8)
    some = [" ", "  ", "\n", "\n\n", "\r\n", "\r", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "a", "word", "'s", "don't", "12", "3", "漢字", "é", "\u0301", "😀", "▁", ";", ");", "}", "<s>", "<|endoftext|>", "<0x0A>", "\x00"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += [r["text"] for r in read_table(spark, "/root/testdata/sf0.001", "documents").collect() if r["text"]]
    a, b = align.Tokens("bpe", open(A, "rb").read()), align.Tokens("piece", open(B, "rb").read())
    assert a.apart and b.apart
    coder, plain_coder = align.Encoder(a, b), align.Encoder(a, b)
    plain_coder.apart = False
    for lo in range(0, len(texts), 500):
        (xa, xb, xo), (ya, yb, yo) = coder.encode(texts[lo : lo + 500]), plain_coder.encode(texts[lo : lo + 500])
        assert all((x == y).all() if len(x) == len(y) else False for x, y in zip(xa + xb, ya + yb)) and xo == yo
