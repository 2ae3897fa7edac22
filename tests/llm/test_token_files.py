from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fundflow.llm import queries, token_files, word_table

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTES)}
TABLES = {p: word_table.WordTable(Path(p).read_text(encoding="utf-8"), 500) for p in (WORD, BYTES)}


def library_ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def table_ids(path, texts, end=None):
    ids, counts = TABLES[path].encode(pa.array(texts, pa.string()), end)
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


# The code


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1))))
def test_round_trip_of_ranks(values):
    ranks = np.array(values, "<u4")
    control, data = token_files.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert token_files.unpack(control, data, len(values)).tolist() == values


def test_layout_of_bytes():
    control, data = token_files.pack(np.array([5, 0x1234, 0x123456, 0x12345678, 1]))
    assert control == bytes([0b11100100, 0])
    assert data == bytes([5, 0x34, 0x12, 0x56, 0x34, 0x12, 0x78, 0x56, 0x34, 0x12, 1])
    with pytest.raises(ValueError):
        token_files.unpack(control, data[:-1], 5)
    with pytest.raises(ValueError):
        token_files.unpack(control, data, 9)


def test_many_ranks():
    ranks = np.random.default_rng(3).integers(0, 1 << 20, 400_001)
    assert (token_files.unpack(*token_files.pack(ranks), len(ranks)) == ranks).all()


# Encoding by words

PIECES = st.sampled_from(
    ["the", "The", "THE", "don't", "we'LL", "a|b", "|", " | ", "12", "é", "É", "É", "ẖ",
     "H̱", "İ", "İ", "Σ", "ΟΔΟΣ", "ß", "K", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>",
     "x", ",", "...", "!?", "'", "'s", " ", "\xa0", "\x85", "\x1c", "　", "中文", "ก็", "हिन्दी", "😀", "‍",
     "\n", "\t", " ", "  ", "\x0b", "_", "-", "²", "ª", "\0", "ñandú", "ﬁ", "À̧", "~", "«", "»"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=8).map("".join), max_size=6))
def test_words_equal_whole_texts(texts):
    assert TABLES[WORD].by_words
    assert table_ids(WORD, texts) == [library_ids(WORD, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_characters(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert table_ids(WORD, texts) == [library_ids(WORD, t) for t in texts]


def test_every_character_after_and_before_a_letter():
    kinds = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}b. X{c}Y " for c in kinds[k : k + 64]) for k in range(0, len(kinds), 64)]
    assert table_ids(WORD, texts) == [library_ids(WORD, t) for t in texts]


def test_files_that_look_across_blanks_are_encoded_text_by_text():
    assert not TABLES[BYTES].by_words
    texts = ["Hello  world\n\n x", None, "", "é"]
    assert table_ids(BYTES, texts, 7) == [library_ids(BYTES, t) + [7] for t in texts]


def test_a_small_table_forgets_but_never_errs():
    table = word_table.WordTable(Path(WORD).read_text(encoding="utf-8"), table_words=10)
    texts = [f"word{k % 40} other{k}, {'long' * 40}" for k in range(200)]
    ids, counts = table.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library_ids(WORD, t)]
    assert len(table._young) <= 10 + 1000 and counts.sum() == len(ids)


# Files


def documents():
    rows = [(k * 7 % 100, f"Text {k} of the corpus, {'ä' * (k % 5)} the end.") for k in range(100)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "no id"), (3, "again"), (3, "again")]
    return rows + [(-5, "before all"), (9_000, "long text " * 20_000), (600, "<|endoftext|> x")]


def test_files_hold_every_document_in_order(spark, tmp_path):
    rows = documents()
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    path = f"{tmp_path}/out"
    token_files.write_tokens(frame.repartition(7), path, WORD, 1, block_ids=100, shard_bytes=300)
    got = token_files.read_tokens(spark, path, partition_bytes=4_000).orderBy("start").collect()
    want = sorted(
        ((i, library_ids(WORD, t) + [1]) for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(np.array(r[1], "<u2").tobytes())),
    )
    assert [(r["doc_id"], r["tokens"]) for r in got] == want
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == r["tokens"] for r in got)
    assert [r["n_tokens"] for r in got] == [len(ids) for _, ids in want]
    assert [r["start"] for r in got] == np.cumsum([0, *[len(ids) for _, ids in want]])[:-1].tolist()
    manifest = json.loads(Path(path, "manifest.json").read_text())
    assert len(manifest["shards"]) > 3
    assert sorted(p.name for p in Path(path).glob("[!.]*")) == sorted(
        ["manifest.json", "ranks", *[s["name"] for s in manifest["shards"]]]
    )
    # The most frequent id has rank 0, ties go by id.
    counts = np.bincount([i for _, ids in want for i in ids])
    order = sorted(np.flatnonzero(counts).tolist(), key=lambda t: (-counts[t], t))
    assert np.frombuffer(Path(path, "ranks").read_bytes(), "<u4").tolist() == order
    # Without ids no code is read; a second write to the folder is refused.
    light = token_files.read_tokens(spark, path, ["doc_id", "n_tokens"])
    assert light.columns == ["doc_id", "n_tokens"] and light.count() == len(want)
    with pytest.raises(ValueError):
        token_files.write_tokens(frame, path, WORD)


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/none"
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, WORD, 1)
    assert token_files.read_tokens(spark, path).count() == 0


def shard(tmp_path, change):
    made = token_files.block([1, None], np.array([2, 1]), np.array([0, 300, 7]))
    (tmp_path / "s").write_bytes(change(token_files._MAGIC + made))
    store, root = token_files._store(str(tmp_path))
    with store.open_input_file(f"{root}/s") as stream:
        return list(token_files.blocks(stream, decode=True))


def test_damaged_shards_fail(tmp_path):
    [one] = shard(tmp_path, lambda b: b)
    assert one.ids == [1, None] and one.counts.tolist() == [2, 1]
    assert one.ranks.tolist() == [0, 300, 7]
    for change, error in (
        (lambda b: b[:-1], EOFError),
        (lambda b: b[:20], EOFError),
        (lambda b: b"x" + b[1:], ValueError),
        (lambda b: b[:-1] + bytes([b[-1] ^ 1]), ValueError),
    ):
        with pytest.raises(error):
            shard(tmp_path, change)


def test_query_equals_the_library(spark, tmp_path):
    rows = [r for r in dict(documents()).items() if r[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_token_files(spark, str(tmp_path)).collect()))
    want, start = [], 0
    for ident, text in sorted(rows):
        ids = [*library_ids(WORD, text), 1]
        want.append((ident, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
