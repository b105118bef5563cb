"""Manifests, packing and whitening against plain Python and numpy."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ringspan.llm import merkle, packing, whitening
from ringspan.llm.queries import BYTE_BPE, QUERIES

DOCS = "doc_id long, source string, lang string, n_chars int, text string"


# --- manifest ------------------------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _climb(digests):
    """The root over ``digests`` and, for each, its siblings as (left, right) from the bottom up."""
    paths, nodes, places = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        for who, place in enumerate(places):
            run = place // 8 * 8
            paths[who].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
        nodes = [_h(*nodes[at : at + 8]) for at in range(0, len(nodes), 8)]
        places = [place // 8 for place in places]
    return nodes[0] if nodes else None, paths


def _brute_manifest(rows):
    lower = str.maketrans(merkle._UPPER, merkle._LOWER)
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = _h(*map(_field, (doc_id, source, lang, n_chars, text)))
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        shown = text.translate(lower) if changed and text is not None else text
        key = (doc_id is not None, doc_id or 0, leaf)
        groups.setdefault(lang, []).append((key, doc_id, leaf, _h(*map(_field, (doc_id, source, lang, n_chars, shown)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {lang: _climb([leaf for _, _, leaf, _ in sorted(groups[lang])]) for lang in order}
    root, upper = _climb([trees[lang][0] for lang in order])
    out = []
    for lang, above in zip(order, upper):
        for (_, doc_id, leaf, shown), path in zip(sorted(groups[lang]), trees[lang][1]):
            folded = shown
            for left, right in path + above:
                folded = _h(left, folded, right)
            proof = _h(*[left + right for left, right in path + above])
            out.append((doc_id, leaf, trees[lang][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def _rows(sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            doc_id = int(rng.integers(0, 10 * size))
            rows.append((doc_id, "web", lang, int(rng.integers(0, 99)), rng.choice(["Ab", "É ß ÀB", "", "plain", "X" * 5000])))
    return rows


ODD = [
    (None, None, None, None, None), (None, "s", "de", 1, "A"), (3, None, "de", None, ""), (3, None, "de", None, ""),
    (3, None, "de", 5, "Zz"), (-7, "s", "de", 1, "Ö A"), (7, "s", "", 1, "A"), (9, "s", "日本", 1, "A b"),
]


@pytest.mark.parametrize(
    "rows",
    [
        ODD,
        _rows({"en": 75, "de": 64, None: 8, "fr": 9, "x": 1}),
        _rows({"en": 513}),
        _rows({f"l{n}": 1 + n % 3 for n in range(20)}),  # more groups than one run
        [(5, "s", "en", 1, "A")] * 100,  # nothing but copies of one row
        [(1, "s", "en", 1, "A")],
    ],
    ids=["odd", "several", "one", "groups", "copies", "single"],
)
def test_manifest(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    clash = docs.withColumns({c: F.lit("x") for c in ("lane", "at", "n", "key", "digest", "path", "children", "found", "root")})
    got = merkle.manifest_report(clash, f"{tmp_path}/m").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == _brute_manifest(rows)


def test_empty_manifest(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    assert merkle.manifest_report(docs, f"{tmp_path}/m").collect() == []
    assert merkle.root_of(merkle.open_manifest(spark, f"{tmp_path}/m")).collect() == []


def test_a_stored_manifest_proves_some_rows(spark, tmp_path):
    rows = _rows({"en": 200, "de": 30})
    stored = merkle.write_manifest(spark.createDataFrame(rows, DOCS), f"{tmp_path}/m")
    again = merkle.open_manifest(spark, f"{tmp_path}/m")
    some = again.leaves.where("at % 13 = 5")
    proofs = merkle.prove(again, some).withColumn("folded", merkle.fold("digest")).collect()
    assert len(proofs) == some.count() > 5
    root = merkle.root_of(stored).first()[0]
    assert all(row["found"] == row["digest"] and row["folded"] == row["root"] == root for row in proofs)


def test_records_tell_children(spark, tmp_path):
    made = merkle.write_manifest(spark.createDataFrame(_rows({"en": 100}), DOCS), f"{tmp_path}/m")
    assert [level.count() for level in made.records] == [13, 2, 1]
    for level in made.records:
        assert all(_h(*row["children"]) == row["digest"] and len(row["children"]) <= 8 for row in level.collect())


# --- packing -------------------------------------------------------------------------------------------------


def _one_by_one(lengths, size):
    """Best-two-fit as it is defined, one sequence after another."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_, gap = [], size
        for length in list(left):
            if length <= gap:
                bin_.append(length)
                left.remove(length)
                gap -= length
        if gap and len(bin_) > 1:
            room, best = gap + bin_[-1], None
            for i, a in enumerate(left):
                for b in left[i + 1 :]:
                    if a + b <= room and (best is None or (a + b, a) > (sum(best), best[0])):
                        best = (a, b)
            if best and sum(best) > bin_[-1]:
                left.append(bin_.pop())
                for length in best:
                    left.remove(length)
                    bin_.append(length)
                left.sort(reverse=True)
        bins.append(sorted(bin_, reverse=True))
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.sampled_from([40, 64]))
def test_best_two_fit_is_the_sequential_one(lengths, size):
    told = packing.best_two_fit(np.bincount(lengths, minlength=size + 1), size)
    bins = [[n for n, k in zip(f.lengths, f.copies) for _ in range(k)] for f in told for _ in range(f.times)]
    assert bins == _one_by_one(lengths, size)


def test_fillings_do_not_grow_with_the_table():
    lengths = np.minimum(np.random.default_rng(1).lognormal(5.5, 1.2, 200_000).astype(int) + 1, 1024)
    counts = np.bincount(lengths, minlength=1025)
    few, many = packing.best_two_fit(counts), packing.best_two_fit(counts * 1000)
    assert len(many) < 1024 * (4 + np.log(1024)) and len(many) < 3 * len(few)
    for told, n in ((few, counts), (many, counts * 1000)):
        packed = np.zeros(1025, np.int64)
        for f in told:
            packed[f.lengths] += np.array(f.copies) * f.times
            assert sum(a * b for a, b in zip(f.lengths, f.copies)) <= 1024
        assert (packed == n).all()
        assert sum(f.times for f in told) <= 1.002 * (n * np.arange(1025)).sum() / 1024 + 2


LIBRARY = Tokenizer.from_file(BYTE_BPE)
TEXTS = ["", " ", "a", "hello world", "日本語 text. " * 7, "word " * 1023, "word " * 1024, "a b c, " * 1500, "x" * 9000, "one. two"] * 4


def _check_packing(report, texts, size=packing.SIZE):
    pieces = {}
    for row in report:
        pieces.setdefault(row["doc_id"], []).append(row)
    assert set(pieces) == set(texts)
    for doc, rows in pieces.items():
        ids = LIBRARY.encode(texts[doc] or "", add_special_tokens=False).ids + [2]
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == [sum(x["length"] for x in rows[:n]) for n in range(len(rows))]
        assert sum(r["length"] for r in rows) == len(ids) and all(r["length"] == size for r in rows[1:])
        for r in rows:
            cut = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(cut.tobytes())
    sequences = {}
    for row in report:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for inside in sequences.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= size
    return sequences


def test_packing(spark, tmp_path):
    texts = dict(enumerate([*TEXTS, None]))
    docs = spark.createDataFrame([(n, t, "x", 1) for n, t in texts.items()], "doc_id long, text string, piece string, length int")
    pieces = packing.write_pieces(docs.repartition(5), f"{tmp_path}/p", BYTE_BPE)
    placed = packing.place_pieces(pieces)
    report = packing.packing_report(pieces, placed).collect()
    sequences = _check_packing(report, texts)
    assert len(sequences) == len(_one_by_one([r["length"] for r in report], packing.SIZE))
    # The sequences hold the ids of their pieces, in place.
    by_id = {row["sequence_id"]: row for row in packing.packed_sequences(pieces, placed).collect()}
    assert set(by_id) == set(sequences)
    for row in report:
        ids = by_id[row["sequence_id"]]["tokens"][row["offset"] : row["offset"] + row["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == row["ids_crc32"]


def test_packing_of_repeated_rows_and_null_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b")] * 50 + [(None, "c")] * 3, "doc_id long, text string")
    pieces = packing.write_pieces(docs, f"{tmp_path}/p", BYTE_BPE)
    report = packing.packing_report(pieces, packing.place_pieces(pieces)).collect()
    assert len(report) == 53 and len({(r["sequence_id"], r["offset"]) for r in report}) == 53
    assert {r["piece"] for r in report} == {0} and {r["sequence_id"] for r in report} == {0}


def test_packing_of_an_empty_table(spark, tmp_path):
    pieces = packing.write_pieces(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/p", BYTE_BPE)
    assert packing.packing_report(pieces, packing.place_pieces(pieces)).collect() == []
    assert packing.packed_sequences(pieces, packing.place_pieces(pieces)).collect() == []


def test_packing_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    report = QUERIES["op12_packing"](spark, folder).collect()
    sequences = _check_packing(report, texts)
    tokens = sum(r["length"] for r in report)
    assert len(sequences) <= 1.01 * tokens / packing.SIZE + 1


# --- whitening -----------------------------------------------------------------------------------------------

SPECTRA = {
    "spread": np.linspace(50, 1, 48), "steep": 2.0 ** -np.arange(40), "equal": np.ones(30),
    "clusters": np.repeat(np.arange(1, 9.0), 6), "deficient": np.r_[np.arange(1, 8.0), np.zeros(33)], "one": np.ones(1),
}


def _with_spectrum(values, seed=3):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    matrix = (q * values) @ q.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_and_feast(name):
    matrix = _with_spectrum(SPECTRA[name])
    wanted = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    form = whitening.tridiagonal(matrix)
    for at in np.linspace(-1.013, wanted[0] + 1.017, 23):
        assert whitening.count_below(*form, at) == (wanted < at).sum()
    most = min(32, int((wanted > 1e-9).sum()))
    found = whitening.intervals_of(matrix, most)
    assert sum(count for *_, count in found) >= most
    values = []
    for low, high, count in found:
        pairs = whitening.feast(matrix, low, high, count)
        assert len(pairs[0]) == count == ((wanted >= low) & (wanted <= high)).sum()
        assert np.abs(matrix @ pairs[1] - pairs[1] * pairs[0]).max() < 1e-11 * wanted[0]
        assert np.abs(pairs[1].T @ pairs[1] - np.eye(count)).max() < 1e-11
        values += pairs[0].tolist()
    assert np.allclose(sorted(values, reverse=True)[:most], wanted[:most], rtol=1e-9, atol=1e-12)


def test_a_wrong_count_is_an_error():
    with pytest.raises(ArithmeticError, match="inertia"):
        whitening.feast(_with_spectrum(SPECTRA["spread"]), 30.0, 40.0, 3)


def _brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    wide = n * x.astype(object) - sums.astype(object)
    centred = (x - sums // n) - sums % n / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:32]
    order = order[values[order] > 1e-11 * max(values.max(), 1e-300)]
    return n, (wide * wide).sum(axis=1), centred @ components[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def _check_whitening(report, ids, vectors):
    n, deviations, white, explained = _brute_whitening(vectors)
    width = white.shape[1]
    assert len(report) == len(ids) * width
    table = np.full((len(ids), width), np.nan)
    row_of = {vec_id: at for at, vec_id in enumerate(ids)}
    for r in report:
        at, c = row_of[r["vec_id"]], r["component"] - 1
        table[at, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[at]
        assert abs(r["explained"] - explained[c]) < 1e-9 and r["identity_error"] < 1e-8
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table * signs - white).max() < 1e-6


def test_whitening_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    fine = [r for r in rows if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    report = QUERIES["op13_whitening"](spark, folder).collect()
    assert {r["component"] for r in report} == set(range(1, 33))
    _check_whitening(report, [r["vec_id"] for r in fine], [r["embedding"] for r in fine])


VECTORS = "vec_id long, embedding array<double>, n int, whitened string"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(n, [float(c) for c in rng.normal(0, [3, 2, 1, 0.5, 0.3])], 1, "x") for n in range(40)]
    bad = [(100, None, 1, "x"), (101, [], 1, "x"), (102, [1.0] * 4, 1, "x"), (103, [1.0, 2.0, None, 1.0, 1.0], 1, "x"),
           (104, [float("nan")] * 5, 1, "x"), (105, [1.0, 1.0, 1.0, 1.0, float("-inf")], 1, "x")]
    report = whitening.whitening_report(spark.createDataFrame(good + bad, VECTORS).repartition(3)).collect()
    _check_whitening(report, [r[0] for r in good], [r[1] for r in good])


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "x")], [(1, [0.5, 1.0], 1, "x")], [(1, [0.5, 1.0], 1, "x")] * 9])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whitening_report(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_repeated_and_large_rows(spark):
    rows = [(n, [float(n % 3) * 40_000, 2.0 * (n % 2), -1.0], 1, "x") for n in range(12)]
    report = whitening.whitening_report(spark.createDataFrame(rows, VECTORS)).collect()
    _check_whitening(report, [r[0] for r in rows], [r[1] for r in rows])
    model = whitening.Whitening(1 << 40, np.array([0]), 1.0, np.ones(1), np.ones((1, 1)))
    with pytest.raises(ArithmeticError):
        model.deviations(np.array([[1 << 30]]))
