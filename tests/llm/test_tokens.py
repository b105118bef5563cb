"""Token files, token counts and pieces against the tokenizer libraries themselves."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringspan.llm import bpe, pieces, token_counts, token_files
from ringspan.llm.queries import BYTE_BPE, PIECE_BPE

LIBRARY = Tokenizer.from_file(BYTE_BPE)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "x. y,z", "x ,y", "a..b, c.,d", "5.5,", ".a", ",", "\n\na\n",
    "x\x85 y", "a\x1fb c", "a\x00b", "日本 語。 x", "é. ç, ñ", "it's. they're, 'tis", "<|endoftext|> a", "q" * 200 + " r",
    "a\tb c", "▁a ▁b", "one two. three,\nfour", "<s>x</s>", "😀 😀😀", "1  2    3", "x" + " " * 40 + "y",
]
ALPHABET = st.sampled_from(list("abcthe ing,.\n'é日0_-") + ["the", " of", ". ", "  "])


def _ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_encoder_is_the_library():
    flat, counts = bpe.Encoder(BYTE_BPE).encode(ODD)
    assert [list(x) for x in np.split(flat, np.cumsum(counts)[:-1])] == [_ids(t) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHABET, max_size=30).map("".join))
def test_encoder_on_any_text(text):
    flat, _ = bpe.encoder(BYTE_BPE).encode([text, text])
    assert flat.tolist() == _ids(text) * 2


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_PIECES", 4)
    coder = bpe.Encoder(BYTE_BPE)
    for _ in range(3):
        for text in ODD:
            assert coder.encode([text])[0].tolist() == _ids(text)


def _table(spark):
    rows = [(n, t, "clash") for n, t in enumerate(ODD)] + [(3, None, "x"), (3, "a b", "x"), (3, "a b", "x"), (None, "c", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, tokens string")


def test_files_round_trip(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    token_files.write_token_files(_table(spark).repartition(3), path, BYTE_BPE)
    read = token_files.read_token_files(spark, path)
    got = sorted(read.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([None, *range(len(ODD)), 3, 3, 3], key=lambda i: (i is not None, i or 0))
    before = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (before, len(r["tokens"]))
        assert r["tokens"][-1] == 0
        before += r["n_tokens"]
    texts = [t for t in [*ODD, "", "a b", "a b", "c"]]
    assert sorted(r["tokens"] for r in got) == sorted(_ids(t) + [0] for t in texts)
    for r, report in zip(got, sorted(token_files.token_report(read).collect(), key=lambda r: r["start"])):
        assert report["ids_crc32"] == zlib.crc32(np.array(r["tokens"], "<u4").tobytes())


def test_files_have_encodings_and_indexes(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    token_files.write_token_files(_table(spark).coalesce(1), path, BYTE_BPE)
    group = pq.ParquetFile(next(p for p in (tmp_path / "tokens").glob("*.parquet"))).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert columns["tokens.list.element"].has_dictionary_page
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    few = token_files.read_token_files(spark, path).where("doc_id = 3").select("doc_id", "start")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in plan and "tokens" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_files_are_encoded_a_little_at_a_time():
    """A worker holds the numbers and ids of about a megabyte of text, however large its batches are."""
    texts = [f"word {n} " * 2000 for n in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rows = list(token_files._rows(iter([batch]), BYTE_BPE, 0, 3))
    assert batch.nbytes > 6 << 20 and max(sum(map(len, texts[r["doc_id"][0].as_py() :][: r.num_rows])) for r in rows) < 1.1 * (1 << 20)
    counts = [n for r in rows for n in r["n_tokens"].to_pylist()]
    assert [n for r in rows for n in r["before"].to_pylist()] == [sum(counts[:n]) for n in range(400)]
    assert [n for r in rows for n in r["doc_id"].to_pylist()] == list(range(400))


def test_files_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_token_files(empty, f"{tmp_path}/none", BYTE_BPE)
    assert token_files.token_report(token_files.read_token_files(spark, f"{tmp_path}/none")).collect() == []


def _brute_sections(text, rule):
    """Token characters from the library's byte counts, looked up one by one."""
    lengths = bpe.encoder(BYTE_BPE).bytes_of
    chars = [i for i, c in enumerate(text) for _ in c.encode()]
    lines = [n for n, line in enumerate(text.split("\n")) for _ in line + "\n"]
    counts, at = {n: 0.0 for n in range(text.count("\n") + 1)}, 0
    for i in _ids(text):
        covered = sorted(set(chars[at : at + lengths[i]]))
        at += lengths[i]
        owners = [lines[c] for c in covered]
        if rule == "first":
            counts[owners[0]] += 1
        elif rule == "last":
            counts[owners[-1]] += 1
        elif rule == "most":
            counts[max(sorted(set(owners)), key=owners.count)] += 1
        else:
            for owner in owners:
                counts[owner] += 1 / len(owners)
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_line_counts(spark, rule):
    texts = [*ODD, "a\n\n\n\nb", "\n\n", "x\n \n\ty\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in token_counts.line_token_counts(docs, BYTE_BPE, rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = r["n_tokens"]
    for n, text in enumerate(texts):
        assert got[n] == pytest.approx(_brute_sections(text, rule)), repr(text)


def test_line_counts_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = token_counts.line_token_counts(docs, BYTE_BPE).collect()
    assert sorted((r["doc_id"] or 0, r["section"], r["n_tokens"]) for r in rows) == [(0, 0, 1), (1, 0, 0), (1, 0, 2), (1, 0, 2)]
    assert token_counts.line_token_counts(docs.limit(0), BYTE_BPE).collect() == []
    with pytest.raises(ValueError):
        token_counts.line_token_counts(docs, BYTE_BPE, "none")


def test_field_counts(spark):
    rows = spark.createDataFrame([(7, "user", "hello there"), (8, None, "x")], "id long, role string, said string")
    got = token_counts.field_token_counts(rows, ["role", "said"], BYTE_BPE, "first", "id").collect()
    counts = {(r["doc_id"], r["section"]): r["n_tokens"] for r in got}
    assert sum(counts[7, s] for s in (0, 1)) == len(_ids("user\nhello there"))
    assert sum(counts[8, s] for s in (0, 1)) == len(_ids("\nx"))


def test_pieces_are_the_library():
    got = pieces.Encoder(PIECE_BPE).encode(ODD)
    assert [g.tolist() for g in got] == [MODEL.encode(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_pieces_on_any_text(text):
    coder = pieces.encoder(PIECE_BPE)
    (ids,) = coder.encode([text])
    assert ids.tolist() == MODEL.encode(text)
    assert coder.vocabulary.decode(ids) == text


def test_pieces_of_long_words_and_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "KEEP_WORDS", 4)
    coder = pieces.Encoder(PIECE_BPE)
    texts = ["ab" * 3000 + " tail", "a" * 1000, "thethe" * 100 + "\n" + "x" * 300, *ODD]
    for _ in range(2):
        for text in texts:
            assert coder.encode([text])[0].tolist() == MODEL.encode(text)


def test_pieces_are_indexed_in_parts(monkeypatch):
    """What an index takes is bounded, however many new words a batch has."""
    sizes = []
    edges = pieces.Index.edges
    monkeypatch.setattr(pieces.Index, "edges", lambda index, codes: (sizes.append(len(codes)), edges(index, codes))[1])
    text = " ".join(f"w{n:x}q{n * 7919:x}" for n in range(40_000))
    assert pieces.Encoder(PIECE_BPE).encode([text])[0].tolist() == MODEL.encode(text)
    assert sum(sizes) > 1 << 18 and max(sizes) <= 300_000


def test_suffix_array():
    codes = np.array([3, 1, 3, 1, 2, 3, 1], np.int32)
    padded = codes.tolist() + [0] * 8
    expected = sorted(range(len(codes)), key=lambda i: padded[i : i + 8])
    assert [padded[i : i + 8] for i in pieces.suffix_array(codes, 8)] == [padded[i : i + 8] for i in expected]


def test_pieces_table(spark):
    encoded = pieces.encode_pieces(_table(spark), PIECE_BPE)
    rows = encoded.collect()
    assert len(rows) == len(ODD) + 4 and all(r["intact"] for r in rows)
    back = pieces.decode_pieces(encoded, PIECE_BPE).collect()
    assert sorted(r["text"] for r in back) == sorted(t.replace("▁", " ") for t in [*ODD, "", "a b", "a b", "c"])
    report = pieces.pieces_report(encoded).collect()
    for r, made in zip(sorted(rows, key=str), sorted(rows, key=str)):
        assert zlib.crc32(np.array(made["pieces"], "<u4").tobytes()) in {x["ids_crc32"] for x in report}
    assert pieces.encode_pieces(_table(spark).limit(0), PIECE_BPE).collect() == []


def test_vocabulary_is_found_by_parameter():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_BPE
