"""Tokens, licences, chat examples and quality rules against brute force, and on odd rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from edge import edge_docs, edge_rows, empty_docs, sentence
from lodestar.llm import bpe, chat, licenses, rules, tokenfile
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken")
ALPHABETS = ["abc", "aeiouth ng", "0123456789", " \n\t", " .!#", "éüñ漢字😀́ß", "etaoin shrdlu"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(bpe.vocabulary(RANKS)), P.PATTERN)


@pytest.fixture(scope="module")
def reference(encoder):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.transducer.ranks, special_tokens={})


def test_transducer_equals_library(encoder, reference):
    rng = random.Random(4)
    tokens = list(encoder.transducer.ranks)
    texts = [t for r in edge_rows() if (t := r[1])]
    for _ in range(3000):
        a = rng.choice(ALPHABETS)
        texts.append("".join(rng.choice(a) for _ in range(rng.randint(0, 60))))
        texts.append(b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))).decode("utf8", "replace"))
    for t in texts:
        assert encoder.encode(t) == reference.encode_ordinary(t)
    assert encoder.encode(None) == encoder.encode("") == []


def test_transducer_on_arbitrary_bytes(encoder):
    rng = random.Random(5)
    tokens = list(encoder.transducer.ranks)
    for _ in range(2000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4)))[:40]
        got = encoder.transducer.encode(piece)
        assert got == ([encoder.transducer.ranks[piece]] if piece in encoder.transducer.ranks else encoder.transducer.merged(piece))
    long = b"ab" * 20_000  # linear in its length
    assert b"".join(encoder.transducer.tokens[i] for i in encoder.transducer.encode(long)) == long


def test_transducer_writes_before_the_end(encoder):
    """Tokens come out while the piece is read: what is held back is bounded."""
    t = encoder.transducer
    t._clear()
    state, written, held = 0, 0, 0
    for byte in b"the" * 300:
        state, out = t.steps[state].get(byte) or t._step(state, byte)
        written += sum(len(t.tokens[i]) for i in out)
        held = max(held, max(len(todo) for _, _, todo in t.hypotheses[state]))
    assert written > 800 and held < 20


def test_small_tables_change_nothing(reference, monkeypatch):
    for name in ("MAX_STATES", "MAX_PAIRS", "MAX_PIECES"):
        monkeypatch.setattr(bpe, name, 5)
    small = bpe.Encoder(bpe.read_ranks(bpe.vocabulary(RANKS)), P.PATTERN)
    for seed in range(20):
        assert small.encode(sentence(seed, 40)) == reference.encode_ordinary(sentence(seed, 40))


def test_stream_decoder_holds_back_open_characters(encoder):
    tokens = encoder.transducer.tokens
    text = "a漢😀é!"
    decoder = bpe.StreamDecoder(tokens)
    out = [decoder.feed([i]) for i in (encoder.transducer.ranks[bytes((b,))] for b in text.encode())]
    assert b"".join(out) + decoder.finish() == text.encode()
    assert all(o.decode() is not None for o in out) and out[1] == out[2] == b""
    for broken in (b"\xff\xfea", b"\xe6\xbc", b"\xf0\x9f\x98a\xc3", b"\xed\xa0\x80"):
        ids = [encoder.transducer.ranks[bytes((b,))] for b in broken]
        assert b"".join(decoder.feed([i]) for i in ids) + decoder.finish() == broken


def test_encode_rows(spark, encoder, reference):
    got = bpe.encode(edge_docs(spark), RANKS, P.PATTERN, digests=True).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        text = r["row"]["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text) and r["n_tokens"] == len(r["ids"]) and r["row"]["score"] == "s"
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(bpe.encode(edge_docs(spark), RANKS, P.PATTERN), RANKS).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((r[1] or "").encode() for r in edge_rows())
    assert bpe.encode(empty_docs(spark), RANKS, P.PATTERN).count() == 0


def test_seekable_file():
    import io

    stream = io.BytesIO()
    writer = tokenfile.SeekableWriter(stream)
    frames = [b"abcd" * k for k in range(1, 50)] + [b""]
    for f in frames:
        writer.frame(f)
    writer.close()
    data = stream.getvalue()
    reader = tokenfile.SeekableReader(io.BytesIO(data), len(data))
    for k in (49, 3, 0, 48):
        assert reader.frame(k) == frames[k]
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(frames)
    assert reader.sums[2] == xxhash.xxh64_intdigest(frames[2]) & 0xFFFFFFFF
    with pytest.raises(ValueError):
        tokenfile.SeekableReader(io.BytesIO(data[:-1]), len(data) - 1)
    bad = bytearray(data)
    bad[int(reader.start[5]) + 8] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfile.SeekableReader(io.BytesIO(bytes(bad)), len(bad)).frame(5)


def test_word_ids_equal_library():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    own, whole = tokenfile.WordIds(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    assert own.by_piece
    rng = random.Random(6)
    parts = ["abcDEF'st ve ll ", "0123 ½²", "éüÑÇßİıŠžſŸ", "漢字 😀", "ΑΣ ας", "áë   x", "<|endoftext|> <|start", "\x00\x0b\x85 -_"]
    texts = ["".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [t for r in edge_rows() if (t := r[1])]
    for t in texts:
        assert own.encode(t) == whole.encode(t, add_special_tokens=False).ids


def test_token_files_round_trip(spark, tmp_path):
    path = P.path("word_bpe_49k.json")
    own = tokenfile.WordIds(open(path, encoding="utf-8").read())
    index = tokenfile.write_ids(edge_docs(spark), str(tmp_path / "out"), path, partitions=4)
    got = sorted(tokenfile.read_ids(index, str(tmp_path / "out")).collect(), key=lambda r: r["row"]["start"])
    assert len(got) == len(edge_rows())
    assert [r["row"]["doc_id"] for r in got] == sorted((r[0] for r in edge_rows()), key=lambda i: (i is None, i))
    start = 0
    for r in got:
        assert r["row"]["start"] == start and r["row"]["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 1
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += len(r["ids"])
    assert Counter(tuple(r["ids"]) for r in got) == Counter((*own.encode(r[1]), 1) for r in edge_rows())
    one = tokenfile.read_ids(index.where("doc_id = 6"), str(tmp_path / "out")).collect()
    assert len(one) == 1 and one[0]["ids"] == [*own.encode(next(r[1] for r in edge_rows() if r[0] == 6)), 1]
    assert tokenfile.write_ids(empty_docs(spark), str(tmp_path / "none"), path).count() == 0


def test_ascii_texts_fall_into_the_same_pieces():
    import regex
    from lodestar.llm.split import ascii_pattern, splitter
    from lodestar.llm.tokenfile import WordIds

    rng = random.Random(12)
    signs = [chr(c) for c in range(128)] + ["  ", "\n\n", "'ll", "'s", "word", "12"] * 4
    for pattern in (P.PATTERN, WordIds.SPLIT):
        assert ascii_pattern(pattern) is not None
        split, every = splitter(pattern), regex.compile(pattern).findall
        for _ in range(3000):
            t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))
            assert split(t) == every(t)
        assert split("été 12 漢字's") == every("été 12 漢字's")
    for pattern in (r"\p{Lu}+", r"(?i:a)\p{L}", r"[[a-z]--[b]]"):
        assert ascii_pattern(pattern) is None


def test_licenses(spark):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500)
    rows = [
        (1, "MIT License text follows"),
        (2, "Copyright (c) 2001 A. Author\n\n" + mit.upper().replace("\n\n", "\n  \n")),
        (3, "x\n  RELEASED  under the MIT Licence!\ny\nreleased under the mit license"),
        (4, "Licensed under the Apache License, Version 2.0."),
        (5, "prefix Licensed under the Apache License, Version 2.0."),
        (6, "© 2020 someone\n (c) 2021 other\nCopyright 2022 third"),
        (None, "Licensed under CC BY-NC 4.0.\nThis work is licenced under the GNU General Public Licence, version 3."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["license_id"], r["scope"], r["n_found"]) for r in licenses.license_hits(docs).collect()}
    assert got == {(2, "MIT", "document", 1), (3, "MIT", "line", 2), (4, "Apache-2.0", "document", 1), (None, "CC-BY-NC-4.0", "line", 1), (None, "GPL-3.0", "line", 1)}
    assert licenses.license_hits(edge_docs(spark)).count() == 0
    assert licenses.license_hits(empty_docs(spark)).count() == 0


def test_license_files(spark):
    """Files as they are found: a title, a copyright line, a line on rights, the text; and long licences as a whole."""
    text = {i: t for i, t in licenses.KNOWN[::-1] if t.startswith(("Permission ", "Redistribution "))}
    rows = [(1, "MIT", f"MIT License\n\nCopyright (c) 2020 A. Author\n\n{text['MIT']}\n")]
    rows += [(2, "MIT", f"The MIT License (MIT)\n\nCopyright (c) 2020 A. Author\nAll rights reserved.\n\n{text['MIT']}")]
    rows += [(3, "ISC", f"ISC License\n\nCopyright 2020, A. Author\n\n{text['ISC']}"), (4, "0BSD", f"All rights reserved.\n{text['0BSD']}")]
    rows += [(5, "BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, A. Author\nAll rights reserved.\n\n{text['BSD-3-Clause']}")]
    rows += [(6, "BSD-2-Clause", f"Copyright (c) 2020, A. Author\n\n{text['BSD-2-Clause'].replace(' with ', chr(10) + 'with ')}")]
    for k, name in enumerate(("Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "CC0-1.0")):
        with open(f"{os.path.dirname(licenses.__file__)}/license_texts/{name}.txt") as f:
            whole = f.read()
        terms = whole.split("END OF TERMS")[0]
        rows += [(10 + k, name, whole), (20 + k, name, terms), (30 + k, name, re.sub(r"(?<!\n)\n(?!\n)", " ", terms))]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    hits = licenses.license_hits(docs).where("scope = 'document'").collect()
    assert sorted((r["id"], r["license_id"]) for r in hits) == sorted((i, n) for i, n, _ in rows)


def test_license_marks_lose_nothing(spark):
    """Every known text has a mark, no change of spelling makes one, and a scan without marks finds the same."""
    rows = spark.createDataFrame([(t,) for _, t in licenses.KNOWN], "t string").select(licenses.canonical(F.col("t")).alias("c")).collect()
    assert all(any(m in r["c"] for m in licenses.MARKS) for r in rows)
    for m in licenses.MARKS:
        assert m.isalpha()  # so its letters stood together before all else became spaces
        for old, new in licenses.SPELLINGS:
            assert m not in new or m in old
            assert new not in m
            for n in range(1, min(len(m), len(new) + 1)):  # a mark that begins or ends within the new spelling did so in the old one
                assert new[-n:] != m[:n] or old[-n:] == m[:n]
                assert new[:n] != m[-n:] or old[:n] == m[-n:]
    rng = random.Random(4)
    bits = ["Released under the MIT Licence.", "licensed", "SPDX-License-Identifier: MIT", "Copyright (c) 2020", "LICEN\u212aE", "nothing here", "", "Permission", "\u0130", *[t for _, t in licenses.KNOWN if len(t) < 200][:20]]
    docs = spark.createDataFrame([(i, "\n".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))) for i in range(400)], "doc_id long, text string")
    known = licenses.known_digests(spark)
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(licenses.license_hits(docs)) == found(licenses.license_hits(docs, known)) != []


def test_canonical_text_is_made_once_a_line(spark):
    plan = licenses.license_hits(edge_docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    side = plan[plan.index("Join Inner") : plan.index("LogicalRDD [doc_id")]
    assert side.count("non-infringement") == 2  # the document's own text, and its lines


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\/INST]", "\\", "<", "[", " [/INST] ", "\n", "é😀"]


def test_chat_examples(spark):
    rng = random.Random(7)
    convs = {}
    for c in range(60):
        roles = [rng.choice(["system", "user", "assistant", "[INST]", "tool"]) for _ in range(rng.randint(1, 6))]
        convs[c] = [(k, r, "".join(rng.choice(CONTROLS) for _ in range(rng.randint(0, 9)))) for k, r in enumerate(roles)]
    rows = [(c, k, r, t, "extra") for c, ts in convs.items() for k, r, t in ts]
    rows += [(100, 0, "user", None, ""), (100, 1, None, "x", ""), (101, 0, "assistant", "same", ""), (101, 0, "assistant", "same", ""), (None, 0, "assistant", "lone", ""), (None, 0, "user", "lone", "")]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.prefix_target_examples(turns)
    got = examples.collect()
    for c, ts in convs.items():
        mine = sorted((r for r in got if r["conv_id"] == c), key=lambda r: r["example"])
        replies = [k for k, r, _ in ts if r == "assistant"]
        assert [r["example"] for r in mine] == sorted({*replies, len(ts) - 1})
        for r in mine:
            target = r["text"][r["loss_start"] : r["loss_end"]]
            want = ts[r["example"]]
            assert (target != "" and want[1] != "assistant") is False
            if want[1] == "assistant":
                assert r["text"][: r["loss_start"]].endswith(" [/INST] ") and r["text"][r["loss_end"] :] == "</s>"
            assert r["text"].count("</s>") == r["example"] + 1
    digests = {}
    for r in chat.conversation_digests(examples).collect():
        digests.setdefault(r["conv_id"], []).append(r)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expect = dict(convs) | {100: [(0, "user", ""), (1, "", "x")], 101: [(0, "assistant", "same")] * 2}
    for c, ts in expect.items():
        (d,) = digests[c]
        loss = "".join(t for _, r, t in ts if r == "assistant")
        assert (d["n_turns"], d["turns_sha256"]) == (len(ts), sha("".join(f"{r}\n{t}\n" for _, r, t in ts)))
        assert (d["loss_chars"], d["loss_sha256"]) == (len(loss), sha(loss))
        assert d["formatted_chars"] == sum(len(r["text"]) for r in got if r["conv_id"] == c)
    assert sorted(d["loss_chars"] for d in digests[None]) == [0, 4]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.prefix_target_examples(empty)).count() == 0


def base_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(covered)


def test_rules_statistics_and_odd_rows(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\na b\na b", "\n\n #$"])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    keys = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for df in (docs, edge_docs(spark)):
        got = rules.base_statistics(df).select("id", *keys).collect()
        want = Counter((r["doc_id"], *base_counts(r["text"])) for r in df.select("doc_id", "text").collect())
        assert Counter(tuple(r) for r in got) == want
    odd = rules.quality_rules(edge_docs(spark)).collect()
    assert len(odd) == len(edge_rows())
    assert all(r["base_failed"] and not r["kept"] and r["distance"] is None for r in odd if r["n_words"] < 10)
    assert all(r["kept"] in (True, False) and r["distance"] is not None for r in odd if not r["base_failed"])
    assert rules.quality_rules(empty_docs(spark)).count() == 0


def test_rules_reject_outliers_only(spark):
    """Each group has its own usual vector; a third of the rows far off doesn't move the estimate."""
    rng = random.Random(9)

    def text(upper, words=60):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(words)]
        return " ".join(x.upper() if rng.random() < upper else x for x in w)

    rows = [(i, text(0.05), "en", "a") for i in range(200)] + [(1000 + i, text(0.9), "en", "b") for i in range(200)]
    rows += [(2000 + i, text(0.05) + " ## $$ %% && ||" * 8, "en", "a") for i in range(40)]
    rows += [(3000, text(0.9), "en", "a"), (3001, text(0.05), "en", "b"), (4000, text(0.05), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["id"]: r["kept"] for r in rules.quality_rules(docs).collect()}
    assert sum(not kept[i] for i in range(200)) <= 2 and sum(not kept[1000 + i] for i in range(200)) <= 2
    assert not any(kept[2000 + i] for i in range(40)) and not kept[3000] and not kept[3001]


def test_mcd_estimate_is_that_of_numpy(spark):
    """The last concentration step by numpy, from the same start, gives the same centre and factor."""
    rng = np.random.default_rng(10)
    x = rng.normal(0, 0.1, (400, 6)) @ (np.eye(6) + 0.3 * rng.normal(size=(6, 6))) + 1
    x[:90] += 3
    rows = spark.createDataFrame([("p", *map(float, r)) for r in x], "pool string, " + ", ".join(f"{v} double" for v in rules.VECTOR))
    got = rules.minimum_covariance(rows, steps=6).first()
    centre = np.array([got[f"m_{i}"] for i in range(6)])
    low = np.zeros((6, 6))
    for i in range(6):
        for j in range(i + 1):
            low[i, j] = got[f"l_{i}_{j}"]
    z = np.linalg.solve(low, (x - centre).T)
    d2 = (z**2).sum(axis=0)
    assert (d2[:90] > rules.CUT).all() and np.median(d2[90:]) < 15
    core = x[np.argsort(d2)[: int(0.75 * len(x)) + 3]]
    assert np.allclose(core.mean(axis=0), centre, atol=0.03)


def test_native_plans_have_no_python(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    for df in (licenses.license_hits(edge_docs(spark)), chat.conversation_digests(chat.prefix_target_examples(turns)), rules.base_statistics(edge_docs(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_a_share_of_the_bpe_tables_gives_the_same_ids(encoder):
    """The pipeline's last stage filled tables of full size beside what the stages before had left in the executor."""
    small = bpe.Encoder(bpe.read_ranks(bpe.vocabulary(RANKS)), P.PATTERN, share=1e-4)
    texts = [f"some words{i} of unequal lengthh{i * 7919} and döcumént {i}" for i in range(60)]
    assert [small.encode(t) for t in texts] == [encoder.encode(t) for t in texts]
    assert len(small.pieces.newer) <= bpe.MAX_PIECES * 1e-4 and small.transducer.max_states == bpe.MAX_STATES // 10000
