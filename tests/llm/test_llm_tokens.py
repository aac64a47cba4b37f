"""Byte-level BPE, token files and Merkle fingerprints against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from pacegrid.llm import bpe, merkle, token_files
from pacegrid.llm.common import vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")
JSON = vocabulary("byte_bpe_50k.json")

SPECIAL = [
    None,
    "",
    " ",
    "'",
    "a'",
    "don't we'll '' 's",
    "a  b   c \n d\n \ne \n",
    "x \t y",
    " lead",
    "trail ",
    "\x00 nul",
    "mixed 漢字 Ünï ½²٣ 🙂 é",
    "<|endoftext|> a<|endoftext|>b <|endoftext|>",
    "　wide　 space\xa0here",
    "word " * 4000,
    "x" * 3000,
]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "ab'stremvdl  \n\t1²½é漢 !-'''\r\x0b\xa0"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={}
    )


def test_token_borders_match_the_pattern():
    batch = [t or "" for t in SPECIAL] + random_texts(3000, 1)
    for text, (found, starts) in zip(batch, bpe.pieces(batch)):
        matches = list(regex.finditer(public_tokenizers.PATTERN, text))
        assert found == [m[0] for m in matches], text
        assert starts.tolist() == [m.start() for m in matches]


def test_all_code_points_are_classed_as_the_library_does():
    expected, ranks = library(), bpe.load_ranks(RANKS)
    for low in range(0, 0x110000, 512):
        codes = [c for c in range(low, low + 512) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1{chr(c)}! " for c in codes)
        ids = [i for p in bpe.pieces([text])[0][0] for i in bpe.merge(p.encode(), ranks)]
        assert ids == expected.encode_ordinary(text), hex(low)


def test_long_pieces_merge_as_short_ones():
    ranks, expected = bpe.load_ranks(RANKS), library()
    rng = random.Random(2)
    for n in (1, 2, 50, 199, 201, 2500):
        piece = "".join(rng.choice("thertionand") for _ in range(n)).encode()
        if piece not in ranks and n > 1:
            assert bpe.merge_long(piece, ranks) == expected.encode_ordinary(piece.decode())
        assert bpe.merge(piece, ranks) == expected.encode_ordinary(piece.decode())


def test_encode_and_decode(spark):
    batch = SPECIAL + random_texts(200, 3) + SPECIAL[:3]
    rows = [(None if i == 5 else i, t, b"x") for i, t in enumerate(batch)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    expected = library()
    encoded = bpe.encode(df, RANKS).collect()
    assert len(encoded) == len(batch)
    for row in encoded:
        text = batch[5 if row["doc_id"] is None else row["doc_id"]] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == expected.encode_ordinary(text)
        assert sum(np.frombuffer(row["piece_tokens"], "<u4")) * 4 == len(row["ids"])
    found = bpe.digests(bpe.decode(bpe.encode(df, RANKS), RANKS)).collect()
    assert sorted(map(str, bpe.digests(bpe.round_trip(df, RANKS)).collect())) == sorted(map(str, found))
    for row in found:
        text = batch[5 if row["doc_id"] is None else row["doc_id"]] or ""
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["n_tokens"] == len(expected.encode_ordinary(text))
    assert bpe.encode(df.where("false"), RANKS).count() == 0


def test_chunk_encoder_matches_the_library():
    own, full = token_files.ChunkEncoder(JSON), Tokenizer.from_file(JSON)
    batch = [t or "" for t in SPECIAL] + random_texts(4000, 4)
    for text, ids in zip(batch, own.encode(batch)):
        assert np.frombuffer(ids, own.kind).tolist() == full.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 5000])
def test_perfect_hash_takes_every_slot_once(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**62), 2**62, n))
    if len(keys):
        moves = token_files.perfect_hash(keys)
        slots = token_files.slot_of(keys, moves[token_files.bucket_of(keys, len(moves))], len(keys))
        assert sorted(slots.tolist()) == list(range(len(keys)))


def test_token_files(spark, tmp_path):
    batch = SPECIAL + random_texts(300, 5)
    rows = [(i * 3 - 40, t) for i, t in enumerate(batch)] + [(None, "no key"), (5, "again"), (5, "again"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    full = Tokenizer.from_file(JSON)

    def ids_of(text):
        return [*full.encode(text or "", add_special_tokens=False).ids, 2]

    manifest = token_files.write_token_files(df, str(tmp_path), JSON)
    found = token_files.read_token_files(manifest, str(tmp_path)).collect()
    expected, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(text)
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found]
    assert sorted(got, key=lambda r: r[1]) == expected
    for key, text in rows[:20]:
        hits = [x.tolist() for x in token_files.look_up(spark, str(tmp_path), manifest, key)]
        assert ids_of(text) in hits
    assert len(token_files.look_up(spark, str(tmp_path), manifest, 5)) == 4 - (5 not in [r[0] for r in rows[:-4]])
    assert token_files.look_up(spark, str(tmp_path), manifest, 10**9) == []
    assert token_files.look_up(spark, str(tmp_path), manifest, 6) == []


def test_token_files_by_key(spark, tmp_path):
    batch = SPECIAL + random_texts(200, 6)
    rows = [(i * 3 - 40, t) for i, t in enumerate(batch)] + [(None, "no key"), (None, "x"), (5, "again"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    manifest = token_files.write_token_files(df, str(tmp_path), JSON)
    every = sorted(token_files.read_token_files(manifest, str(tmp_path)).collect(), key=lambda r: r["start"])
    found = token_files.read_by_key(df, manifest, str(tmp_path)).collect()
    assert sorted(found, key=lambda r: r["start"]) == every and len(every) == len(rows)
    some = spark.createDataFrame([(5,), (-40,), (5,)], "doc_id long")
    asked = token_files.read_by_key(some, manifest, str(tmp_path)).collect()
    assert sorted(asked, key=lambda r: r["start"]) == [r for r in every if r["doc_id"] in (5, -40)]
    strange = spark.createDataFrame([(-39,)], "doc_id long")
    with pytest.raises(Exception, match="no shard holds -39"):
        token_files.read_by_key(strange, manifest, str(tmp_path)).collect()
    # Damage to the hash part of an index is found, though keys and offsets are whole.
    path = next(p for p in sorted(tmp_path.glob("*.idx")))
    raw = bytearray(path.read_bytes())
    _, _, buckets, keys, _, _ = token_files.HEADER.unpack_from(raw)
    at = token_files.HEADER.size + 4 * buckets
    raw[at : at + 4 * keys] = bytes(b ^ 255 for b in raw[at : at + 4 * keys])
    path.write_bytes(raw)
    with pytest.raises(Exception, match="no shard holds"):
        token_files.read_by_key(df, manifest, str(tmp_path)).collect()


def test_token_files_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    manifest = token_files.write_token_files(df, str(tmp_path), JSON)
    assert token_files.read_token_files(manifest, str(tmp_path)).count() == 0
    assert token_files.read_by_key(df, manifest, str(tmp_path)).count() == 0


def test_roots_and_branches():
    text = "\n".join(f"Paragraph {i} says this. And that." for i in range(200))
    changed = text.replace("Paragraph 120 says", "Paragraph 120 denies")
    assert merkle.fingerprint(text) == merkle.fingerprint(str(text))
    assert merkle.fingerprint(text)[:32] != merkle.fingerprint(changed)[:32]
    found = merkle.differing(text, changed)
    paragraphs = [p for _, below in merkle.tree(changed)[1] for p in below]
    assert len(paragraphs) == 200 and len(found) == 1
    section, place = found[0]
    before = sum(len(below) for _, below in merkle.tree(changed)[1][:section])
    assert before + place == 120
    assert merkle.differing(text, text) == []
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(changed)) > 0.98
    inserted = "A new first line.\n" + text
    assert merkle.differing(text, inserted) == [(0, 0)]
    assert len({merkle.fingerprint(t) for t in ("", " ", "\n", "a\n", "a", "a b", "a. b", "a.  b")}) == 8


def test_compare_with_next(spark):
    rng = random.Random(6)
    words = ["alpha", "beta.", "gamma\n", "delta", "ä漢🙂"]
    batch = [None, "", "one"] + [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(60)]
    rows = [(i * 7 % 101, t) for i, t in enumerate(batch)] + [(None, "nothing"), (0, "tie"), (0, "tie")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, place string").repartition(7)
    found = merkle.compare_with_next(df).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        new = merkle.edited(text, following)
        own = merkle.fingerprint(text)
        expected.append(
            (
                key,
                len(text),
                hashlib.sha256(new.encode()).hexdigest(),
                own,
                merkle.fingerprint(new),
                merkle.likeness(own, merkle.fingerprint(new)),
                merkle.likeness(own, merkle.fingerprint(following)),
            )
        )
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert merkle.compare_with_next(df.where("false")).count() == 0
    assert [r["doc_id"] for r in merkle.compare_with_next(df.where("doc_id = 7")).collect()] == [7]


def test_edited_text():
    assert merkle.edited("abcde", "xyz") == "abcxy"
    assert merkle.edited("abcdef", "x") == "abcx"
    assert merkle.edited("", "x") == ""
