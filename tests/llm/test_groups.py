"""Near duplicates of vectors, documents and lines against brute force, and the components they share."""

import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ringspan.llm import embedding_dedup, jaccard, line_dedup
from ringspan.llm.components import connected_components
from ringspan.llm.scratch import HashFilter, Scratch, hash_filter


def components(nodes, links):
    """Smallest reachable node, by walking."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    links += [(n, n + 1) for n in range(1000, 1100)] + [(2000, n) for n in range(2001, 2300)] + [(-5, 3000), (7, 7)]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    rows = [*links, (None, 4), (4, None)]
    got = connected_components(spark.createDataFrame(rows, "a long, b long"), Scratch(spark, "t")).collect()
    assert {r["node"]: r["component"] for r in got} == components(nodes, [x for x in links if x[0] != x[1]])
    assert len(got) == len(nodes)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).collect() == []


def test_filter_loses_nothing(spark):
    found = hash_filter(spark.range(0, 50_000, 7).select("id"))
    assert found.has(np.arange(0, 50_000, 7)).all()
    assert found.has(np.arange(10**9, 10**9 + 10_000)).mean() < 0.01
    assert HashFilter(np.full(1 << 22, 255, np.uint8)).has(np.arange(100)).all()


def test_shuffles_of_saved_tables_go(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(d.getPath()) for d in env.blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f.name for folder in folders for f in folder.rglob("shuffle_*.data")}

    before = shuffles()
    counted = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    saved = Scratch(spark, "t").save(counted, "counted")
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left
    assert saved.count() == 7
    # Other queries keep what the session says.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_arrays_are_added_up_in_few_jobs(spark):
    """However many partitions a shuffle has: jobs that follow each other do not get shorter with more machines."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("arrays", "arrays")
    try:
        found = hash_filter(spark.range(0, 50_000, 7).select("id"))
        assert found.has(np.arange(0, 50_000, 7)).all()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("arrays")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < len(jobs) < 10


# --- vectors -------------------------------------------------------------------------------------------------


def _vectors():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(n, list(map(float, rng.normal(size=16)))) for n in range(60)]
    # One group of near copies, larger than a block; equal vectors; the same direction in other lengths.
    rows += [(100 + n, list(map(float, centre + rng.normal(size=16) * 0.12))) for n in range(90)]
    rows += [(300 + n, [1.0] * 16) for n in range(5)] + [(310, [2.5] * 16), (311, [1e200] * 16), (312, [1e-200] * 16)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(400 + n, v) for n, v in enumerate(odd)]
    rows += [(500, [1.0, 2.0]), (501, [1.0, 2.0, 0.0]), (502, [2.0, 4.0]), (7, rows[7][1]), (None, rows[8][1])]
    return rows


def _brute_vectors(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / max(map(abs, v))
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v in rows]
    return [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95
    ]


@pytest.mark.parametrize("block", [2048, 25])
def test_vectors(spark, block):
    rows = _vectors()
    links = _brute_vectors(rows)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string")
    got = embedding_dedup.near_duplicates(frame, bits=6, tables=40, block=block).collect()
    assert len(got) == len(rows)
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert sorted((r["vec_id"] or -1, r["n_links"]) for r in got) == sorted((r[0] or -1 if r[0] != 0 else -1, d) for r, d in zip(rows, degree)) or (
        sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"]) for r in got)
        == sorted((-1 if r[0] is None else r[0], d) for r, d in zip(rows, degree))
    )
    group = components(range(len(rows)), links)
    low = {}
    for i, c in group.items():
        if rows[i][0] is not None:
            low[c] = min(low.get(c, 10**9), rows[i][0])
    want = sorted((-1 if r[0] is None else r[0], low[group[i]]) for i, r in enumerate(rows))
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# --- documents -----------------------------------------------------------------------------------------------


def _documents():
    rng = random.Random(5)
    vocabulary = [f"w{n}" for n in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    texts += [f"{t} {passage}" for t in texts[:30]]
    base = rng.choices(vocabulary, k=150)
    for _ in range(40):  # near copies of each other, in chains
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [passage] * 4 + [passage.upper(), passage + " tail", "a b c", "A  b\tc", "a b", "", " \n ", None, "é è", "\x85 a b"]
    return texts


def _shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def _brute_documents(texts, percent=80):
    sets = [_shingle_set(t) for t in texts]
    return sets, [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


@pytest.mark.parametrize("percent", [80, 50])
def test_documents(spark, percent):
    texts = _documents()
    sets, links = _brute_documents(texts, percent)
    frame = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, node string")
    got = jaccard.similar_documents(frame, similarity=percent / 100).collect()
    group = components(range(len(texts)), links)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {
        n: (len(sets[n]), group[n]) for n in range(len(texts))
    }


def test_documents_of_equal_and_unknown_ids(spark):
    long = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, long), (5, long), (3, long + " x"), (None, long), (None, "alone here"), (None, None), (9, "other text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similar_documents(frame).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted(
        [("5", "3"), ("5", "3"), ("3", "3"), ("None", "3"), ("None", "None"), ("None", "None"), ("9", "9")]
    )
    kept = jaccard.keep_one_per_group(frame).collect()
    assert sorted(map(str, kept)) == sorted(
        str(r) for r in frame.collect() if r["doc_id"] in (3, 9) or r["text"] in ("alone here", None)
    )
    assert jaccard.similar_documents(frame.limit(0)).collect() == []


def test_documents_that_share_half_make_no_pairs(spark, monkeypatch):
    """All pairs of a dozen passages: each document shares half with twenty others, and is similar to one only."""
    made = []
    verified = jaccard._Join.verified
    monkeypatch.setattr(jaccard._Join, "verified", lambda join, pairs: (made.append(pairs.count()), verified(join, pairs))[1])
    passages = [" ".join(f"p{n}w{i}" for i in range(60)) for n in range(12)]
    texts = [f"{passages[i]} {passages[j]}" for i in range(12) for j in range(i)]
    texts += [f"{text} tail" for text in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(frame).collect()}
    sets, links = _brute_documents(texts)
    assert got == components(range(len(texts)), links)
    # The last ones are pairs of different groups under a shingle.
    assert made[-1] == 0


def test_parities_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(12)
    for size in (1, 40, 500, 3000):
        x = np.unique(rng.integers(0, 1 << 62, size))
        for kept in (0, size // 2, size - 1):
            y = np.unique(np.append(x[:kept], rng.integers(0, 1 << 62, rng.integers(1, size + 1))))
            differ = sum(((p ^ q) & 0xFFFFFFFFFFFFFFFF).bit_count() for p, q in zip(jaccard._parities(x), jaccard._parities(y)))
            assert differ <= len(np.setxor1d(x, y))


# --- lines ---------------------------------------------------------------------------------------------------


def _normal(line):
    return " ".join(re.sub(r"[!-/:-@\[-`{-~]+", "", line.lower()).split())


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_equal_lines(spark):
    rows = [
        (4, "Alpha beta gamma.\nown line of four\nshort\n\nshort"),
        (2, "alpha, BETA gamma\nanother line of two"),
        (9, "alpha beta gamma!\nAlpha beta -- gamma"),
        (None, "another line of two\nonly here it stands"),
        (6, None),
        (7, ""),
        (2, "alpha, BETA gamma\nanother line of two"),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_chars long, `line` string")
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in line_dedup.dedupe_lines(docs).collect()), key=str)
    assert got == sorted(
        [
            (2, rows[1][1], 1),
            (2, rows[1][1], 1),
            (4, "own line of four\nshort\n\nshort", 29),
            (None, "only here it stands", 19),
            (6, None, 1),
            (7, "", 1),
        ],
        key=str,
    )
    assert line_dedup.dedupe_lines(docs.limit(0)).collect() == []


def _similar_lines():
    """Long lines with small edits, in chains, and unrelated ones."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    lines = [" ".join(rng.choices(words, k=rng.randint(5, 70))) for _ in range(40)]
    for base in lines[:12]:
        for _ in range(4):
            parts = base.split()
            parts[rng.randrange(len(parts))] = rng.choice(words)
            lines.append(" ".join(parts))
    return lines


def _similar(x, y):
    return _distance(x, y) <= 0.2 * max(len(x), len(y))


def test_sketches_never_rule_out_what_is_shared():
    rng = np.random.default_rng(11)
    for size in (1, 5, 64, 65, 500, 3000):
        for share in (0.0, 0.5, 0.9, 1.0):
            x = np.unique(rng.integers(0, 1 << 62, size))
            y = np.concatenate([x[: int(share * len(x))], rng.integers(0, 1 << 62, rng.integers(0, size + 1))])
            y = np.unique(np.append(y, x[0]))
            shared = len(np.intersect1d(x, y))
            most = jaccard._most_shared(jaccard._sketch(x), jaccard._sketch(y))
            assert shared <= most <= min(len(x), len(y))
    # Counters that don't hold their counts say nothing.
    alike = np.arange(5000) << 20
    for other in (alike, alike[:4500], np.arange(4000)):
        shared = len(np.intersect1d(alike, other))
        assert shared <= jaccard._most_shared(jaccard._sketch(alike), jaccard._sketch(other))
    # Different sets of some size are ruled out.
    x, y = rng.integers(0, 1 << 62, (2, 2000))
    assert jaccard._most_shared(jaccard._sketch(x), jaccard._sketch(y)) < 0.8 * 2000


def test_only_wanted_texts_are_taken_apart(monkeypatch):
    """The sets of a few candidates must not cost shingles of the whole table."""
    looked_at = []
    sets = jaccard._sets

    def counted(column, size, classes):
        looked_at.extend(column.to_pylist())
        return sets(column, size, classes)

    monkeypatch.setattr(jaccard, "_sets", counted)
    texts = [" ".join(f"w{n}x{k}" for k in range(30)) for n in range(50)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "body": list(range(50))})
    wanted = HashFilter(np.zeros(1 << 22, np.uint8))
    for places in wanted.places(np.array([3, 41])):
        np.bitwise_or.at(wanted.bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    classes = np.zeros(2 << 21, np.uint8)
    got = list(jaccard._members(iter([batch]), 5, classes, wanted))
    assert looked_at == [texts[3], texts[41]]
    found = [np.frombuffer(m, np.int64) for b in got for m in b.column("members").to_pylist()]
    assert [len(m) for m in found] == [26, 26]


def test_postings_are_the_prefixes_of_sets():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 40, size)) for size in (1, 3, 5, 60, 200, 60)]
    texts = [texts[0], "", *texts[1:], texts[3]]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8)), "body": list(range(8)), "text": texts})
    classes = rng.integers(0, 9, 2 << 21).astype(np.uint8)
    (rows,) = jaccard._row_nodes(iter([batch]), 5, classes, 80)
    # A text without words has no node; a set that a task has met has its prefix once.
    assert rows.column("node").null_count == 1 and rows.column("prefix").null_count == 2
    assert rows.column("node")[4] == rows.column("node")[7]
    firsts = rows.filter(rows.column("prefix").is_valid())
    firsts = firsts.select(["node", "n_shingles", "prefix"]).rename_columns(["node", "size", "prefix"])
    want = {}
    for row, shingles in jaccard._sets(pa.array(texts), 5, classes):
        assert (np.diff(shingles) > 0).all()
        least = -(-80 * len(shingles) // 100)
        want[jaccard._node(shingles)] = shingles[: len(shingles) - least + 1].tolist()
    got = {}
    # Slices of a batch begin behind its first bytes.
    for part in (firsts.slice(0, 2), firsts.slice(2)):
        for out in jaccard._postings(iter([part])):
            for shingle, node, place in zip(*(out.column(c).to_pylist() for c in ("shingle", "node", "place"))):
                assert place == len(got.setdefault(node, []))
                got[node].append(shingle)
    assert got == want


def test_similar_lines(spark):
    """All pairs by edit distance, without any filter of the operator's own."""
    lines = _similar_lines()
    norms = [_normal(line) for line in lines]
    sizes = [len(norm) for norm in norms]
    links = [
        (i, j)
        for i in range(len(lines))
        for j in range(i)
        if min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j]) and _similar(norms[i], norms[j])
    ]
    assert len(links) >= 100
    group = components(range(len(lines)), links)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == {n for n in range(len(lines)) if group[n] == n}


def _all_blocks(spark, lines):
    """Per line the SimHashes of all its windows, and of every word its hash."""
    rows = [(n, _normal(line).split(" ")) for n, line in enumerate(lines)]
    frame = spark.createDataFrame([(n, words, len(words)) for n, words in rows], "n int, words array<string>, size int")
    got = frame.select("n", F.expr(line_dedup._blocks(1 << 20)).alias("blocks")).collect()
    words = frame.select(F.explode("words").alias("w")).distinct().select("w", F.xxhash64("w").alias("h")).collect()
    return {r["n"]: set(r["blocks"]) for r in got}, {r["w"]: r["h"] for r in words}


def test_simhash_of_windows_by_brute_force(spark):
    lines = ["alpha beta gamma delta epsilon", "a b c d", "one two two three one one", " ".join(f"w{n}" for n in range(3000))]
    blocks, hashes = _all_blocks(spark, lines)
    for n, line in enumerate(lines):
        words = line.split(" ")
        want = set()
        for at in range(len(words) - 3):
            four = [hashes[w] for w in words[at : at + 4]]
            bits = sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in four) > 2)
            want.add(bits - (bits >> 63 << 64))
        assert blocks[n] == want


def test_an_edit_leaves_other_blocks(spark):
    words = [f"word{n}" for n in range(40)]
    lines = [" ".join(words), " ".join([*words[:20], "other", *words[21:]])]
    blocks, _ = _all_blocks(spark, lines)
    assert len(blocks[0]) == 37 and len(blocks[0] & blocks[1]) == 33


@pytest.mark.parametrize("others", [100, 400])
def test_lines_under_a_hot_key(spark, others):
    """However many unlike lines share a key, two similar ones among them are found; of equal distances all are links."""
    rng = random.Random(others)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choices(letters, k=6))
    shared = "zzzzzzzzzz yyyyyyyyyy xxxxxxxxxx wwwwwwwwww vvvvvvvvvv uuuuuuuuuu"
    lines = [f"{shared} {' '.join(word() for _ in range(10))}" for _ in range(others)]
    base = f"{shared} {' '.join(word() for _ in range(10))}"
    lines += [base, f"{base[:-6]}{word()}", f"{base[:-6]}{word()}", base.upper()]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == set(range(others + 1))


def test_unlike_lines_of_a_common_block_are_no_pairs(spark, monkeypatch):
    """Lines that share four words in a row and nothing else never become pairs; a similar one among them is found."""
    rng = random.Random(4)
    word = lambda size: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size))
    lines = [" ".join(["zzzzzzzzzz yyyyyyyyyy xxxxxxxxxx wwwwwwwwww", *(word(6) for _ in range(14))]) for _ in range(200)]
    lines.append(f"{lines[7][:-6]}{word(6)}")
    made, save = [], Scratch.save

    def counted(self, df, name):
        saved = save(self, df, name)
        if name in ("stars", "across"):
            made.append(saved.count())
        return saved

    monkeypatch.setattr(Scratch, "save", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == set(range(200)) and len(made) == 2 and sum(made) < 20


def test_lines_that_share_one_block_only(spark):
    """Every word outside one block has another letter, so no word beside it is shared; elsewhere the block joins nothing."""
    block = "zzzzzzzzzz yyyyyyyyyy xxxxxxxxxx wwwwwwwwww"
    words = [f"{c}bcde" for c in "abcdefgh"]
    other = [f"{word[:-1]}q" for word in words]
    lines = [" ".join([*some[:4], block, *some[4:]]) for some in (words, other)]
    lines.append(" ".join([block, *(f"m{c}nop" for c in "abcdefgh")]))
    assert 0 < _distance(*lines[:2]) <= 0.2 * len(lines[0]) and not _similar(lines[0], lines[2])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == {0, 2}


def test_long_lines_with_edits_all_over(spark):
    """Lines that are cut into pieces: edits in few and in too many places, and words put in that shift the pieces."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    base = [word() for _ in range(200)]
    lines = [base]
    for share in (0.1, 0.2, 0.35):
        lines.append([word() if rng.random() < share else w for w in base])
    lines.append([*base[:20], *(word() for _ in range(25)), *base[20:]])
    lines = [" ".join(words) for words in lines]
    near = [_similar(lines[0], line) for line in lines]
    assert near == [True, True, True, False, True] and not any(_similar(lines[3], line) for line in lines if line != lines[3])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == {0, 3}


def test_tables_of_a_run_go(spark, monkeypatch):
    """Of what a run has saved only the table is left that its result reads."""
    runs = []

    class Kept(Scratch):
        def __init__(self, *args):
            super().__init__(*args)
            runs.append(self)

    for module in (line_dedup, jaccard):
        monkeypatch.setattr(module, "Scratch", Kept)
    words = " ".join(f"word{n}" for n in range(30))
    docs = spark.createDataFrame([(1, words), (2, f"{words} more"), (3, "own line of it")], "doc_id long, text string")
    for result in (line_dedup.dedupe_lines(docs), jaccard.keep_one_per_group(docs)):
        assert {r["doc_id"] for r in result.collect()} == {1, 3}
    assert [len(run._paths) for run in runs] == [1, 1]


def test_lines_run_no_python(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma\nx"), (2, "alpha beta gamma")], "doc_id long, text string")
    plan = line_dedup.dedupe_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lines_of_other_marks_are_equal(spark):
    """Whatever is neither letter nor digit parts words, in ASCII and beyond."""
    lines = [
        "It’s a “well-known” e–mail address",
        "it's a \"well known\" e-mail address",
        "«It s a well known» e mail   address",
        "une idée «très» claire",
        "Une idée très claire",
        "une idee tres claire",
        "एक दो तीन",
    ]
    frame = spark.createDataFrame([(lines,)], "lines array<string>")
    got = frame.select(line_dedup.normalised(frame["lines"]).alias("norm")).first()["norm"]
    assert got[0] == got[1] == got[2] == "it s a well known e mail address"
    assert got[3] == got[4] == "une idée très claire" != got[5]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert not kept & {1, 2, 4} and {0, 3, 6} <= kept


def test_runs_of_marks_become_one_space(spark):
    """Against the plain expression, in ASCII and beyond."""
    random.seed(5)
    lines = ["".join(random.choices(signs, k=random.randint(0, 12))) for signs in ("ab1  .-\t", "aé日 \u00a0 –.1") for _ in range(300)]
    frame = spark.createDataFrame([(lines,)], "lines array<string>")
    plain = F.transform("lines", lambda line: F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")))
    row = frame.select(line_dedup.normalised(frame["lines"]).alias("got"), plain.alias("want")).first()
    assert row["got"] == row["want"]


def test_letters_bound_the_edit_distance(spark):
    """The surplus of letters is never above the distance, so no similar line is passed over, and it does pass over some."""
    random.seed(6)
    rows = []
    for signs in ("ab ", "abcdefgh xyz1", "aé日 z9"):
        for _ in range(200):
            x = random.choices(signs, k=random.randint(1, 30))
            y = list(x)
            for _ in range(random.randint(0, 8)):
                at = random.randrange(len(y) + 1)
                y[at : at + random.randint(0, 1)] = random.choices(signs, k=random.randint(0, 1))
            rows.append(("".join(x), "".join(y)))
    frame = spark.createDataFrame(rows, "x string, y string")
    frame = frame.withColumns({"p": line_dedup._letters("x"), "q": line_dedup._letters("y")})
    bounds = [line_dedup._surplus(*sides).alias("".join(sides)) for sides in ("pq", "qp")]
    got = frame.select(*bounds, F.levenshtein("x", "y").alias("edits"), F.size("p").alias("n")).collect()
    assert all(max(r["pq"], r["qp"]) <= r["edits"] for r in got) and got[0]["n"] == 28
    assert sum(max(r["pq"], r["qp"]) == r["edits"] > 0 for r in got) > 50


def test_lines_with_words_changed(spark):
    """One word in ten or more, two in ten, and words put in: pairs that share too few bits of their fingerprints."""
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(4000)]
    rows = []
    for size in (6, 10, 20, 30, 50, 100):
        for changed in (1, size // 10 + 1):
            base = rng.choices(words, k=size)
            copy = list(base)
            for at in rng.sample(range(size), changed):
                copy[at] = rng.choice(words)
            rows += [base, copy, [*base[:2], rng.choice(words), *base[2:]]]
    rows = [" ".join(row) for row in rows]
    for n in range(0, len(rows), 3):
        for copy in (rows[n + 1], rows[n + 2]):
            if _distance(rows[n], copy) > 0.2 * max(len(rows[n]), len(copy)):
                rows[rows.index(copy)] = rows[n]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_dedup.dedupe_lines(docs).collect()}
    assert kept == set(range(0, len(rows), 3))


def test_equal_lines_of_any_length(spark):
    """op5 and the pipeline treat lines of one word as well, a paragraph without spaces among them."""
    paragraph = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。"
    rows = [(1, f"short\n{paragraph}\n\nshort"), (2, f"Short!\nown\n\n{paragraph}"), (3, "own line\nown")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedupe_lines(docs, min_words=1).collect()}
    assert got == {1: f"short\n{paragraph}\n", 2: "own\n", 3: "own line"}
    import corpus_pipeline

    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()} == got
