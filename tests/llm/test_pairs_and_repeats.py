"""Near duplicates, repeated windows and lines, against brute force."""

import hashlib
import importlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm import jaccard, lines, suffixes
from lodestone.llm.components import components
from lodestone.llm.perfect_hash import PerfectHash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def linked_components(rows, size, percent):
    sets = [(d, shingles(t, size)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return sorted((d, len(s), find(d)) for d, s in sets)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_components_are_those_of_all_pairs(docs, rows, size, percent):
    got = jaccard.similar(docs, size, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == linked_components(rows, size, percent)


def test_crowded_families_are_cut_and_lose_no_link(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWDED", 2)
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == linked_components(rows, 4, 85)


def test_families_of_chance_are_parted_before_arrays_move(spark, tmp_path, monkeypatch):
    """Passages connect all documents, and few of them link: tiles get each class twice at most, not once for each block
    of the family's grid."""
    n = 200
    passage = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(n)]
    given = [(i, " ".join((passage[i], passage[(i + 1) % n], passage[(i + 5) % n]))) for i in range(n)]
    given += [(n + i, given[i][1] + " more") for i in range(0, n, 10)]
    real, folder = jaccard.link_tile, str(tmp_path)

    def counted(rows, *more):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(rows.num_rows))
        return real(rows, *more)

    monkeypatch.setattr(jaccard, "CROWDED", 8)
    monkeypatch.setattr(jaccard, "link_tile", counted)
    got = jaccard.similar(spark.createDataFrame(given, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == linked_components(given, 4, 85)
    assert 0 < sum(int(x.read_text()) for x in tmp_path.iterdir()) <= 2 * len(given)


def test_sketches_never_part_what_links():
    rng = np.random.default_rng(6)
    for n in (1, 7, 60, 900, 5000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        near = [np.unique(np.concatenate((base[int(rng.integers(0, 1 + n // 12)) :], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 12))).astype(np.uint64)))) for _ in range(12)]
        far = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for _ in range(4)]
        sets = [base, *near, *far]
        rows = pa.table({"key": np.zeros(len(sets), np.int64), "band": np.zeros(len(sets), np.int32), "c": np.arange(len(sets)), "n": np.array([len(x) for x in sets]), "sketch": pa.array([jaccard.sketch(x) for x in sets], pa.binary())})
        out = jaccard.link_sketches(rows, 85)
        label = dict(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if jaccard.linked(jaccard.overlap(x, y), len(x), len(y), 85):
                    assert label.get(i, i) == label.get(j, j)
        if n == 60:
            assert not {13, 14, 15, 16} & set(label)
        pairs = [rows.take([i, j]).set_column(0, "key", pa.array([k, k])) for k, (i, j) in enumerate((i, j) for i in range(len(sets)) for j in range(i))]
        out = jaccard.link_sketches(pa.concat_tables(pairs), 85)
        told = set(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
        assert all((i, j) in told for i in range(len(sets)) for j in range(i) if jaccard.linked(jaccard.overlap(sets[i], sets[j]), len(sets[i]), len(sets[j]), 85))


@pytest.mark.parametrize("hub", [1000, 1])
def test_common_shingles_and_labels_are_dealt_out(spark, rows, monkeypatch, hub):
    monkeypatch.setattr(importlib.import_module("lodestone.llm.components"), "HUB", hub)
    monkeypatch.setattr(jaccard, "HOT_BUCKET", 1)
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == linked_components(rows, 4, 85)


@pytest.mark.parametrize("crowded", [1024, 2])
def test_links_are_counted_as_of_all_pairs(spark, rows, monkeypatch, crowded):
    monkeypatch.setattr(jaccard, "CROWDED", crowded)
    words = [f"w{i}" for i in range(90)]
    more = [(2000 + i, " ".join([*words[:i], "x", *words[i:]]), "en", "s", 0) for i in range(0, 90, 15)] * 2  # all near copies of each other
    given = [*rows, *more]
    sets = [shingles(t, 4) for _, t, *_ in given]
    want = sorted((d, sum(100 * len(x & y) >= 85 * len(x | y) for j, y in enumerate(sets) if j != i and x and y)) for i, ((d, *_), x) in enumerate(zip(given, sets, strict=True)))
    frame = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    got = jaccard.similar(frame, 4, 85, links=True)
    assert sorted((r["doc_id"], r["n_links"]) for r in got.collect()) == want and max(n for _, n in want) == 11


def test_chains_of_near_copies_are_one_component(spark):
    words = [f"w{i}" for i in range(100)]
    chain = []
    for i in range(12):
        words[i * 5] = f"new{i}"
        chain.append((i, " ".join(words)))
    got = jaccard.similar(spark.createDataFrame(chain, "doc_id long, text string"), 4, 85).select("doc_id", "component_id").collect()
    want = {d: c for d, _, c in linked_components(chain, 4, 85)}
    assert {r[0]: r[1] for r in got} == want


def test_bitmap_bound_never_falls_short():
    rng = np.random.default_rng(1)
    for n in (3, 40, 300):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[: n // 2], rng.integers(0, 2**63, n // 2).astype(np.uint64))))
        a, b = sorted((x, y), key=len)
        tile = jaccard.Tile(np.array([len(a), len(b)]), [jaccard.bitmap(a), jaccard.bitmap(b)], 1)
        words = int(tile.width[0])
        bits = tile.bitmaps(words)
        most = len(a) - np.bitwise_count(bits[0] & ~bits[1]).sum()
        assert most >= jaccard.overlap(a, b) == len(set(a.tolist()) & set(b.tolist()))


@pytest.mark.parametrize("hub", [1000, 2])
def test_connected_components_of_random_edges(spark, monkeypatch, hub):
    monkeypatch.setattr(importlib.import_module("lodestone.llm.components"), "HUB", hub)
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)
    assert set(got) == set(near)


def test_repeated_windows_go_byte_for_byte(docs, rows):
    got = {}
    for r in suffixes.remove_repeats(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest(), r["n_repeated_words"]))
    want = defaultdict(list)
    for (d, *_), x in zip(rows, suffixes.brute_force([(t or "").encode() for _, t, *_ in rows]), strict=True):
        want[d].append(x)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize(("length", "gram", "step", "words"), [(12, 4, 3, 7), (30, 8, 30, 12), (5, 5, 1, 1), (3, 1, 2, 4)])
def test_repeats_of_other_lengths(docs, rows, length, gram, step, words):
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"], r["n_repeated_words"]) for r in suffixes.remove_repeats(docs, length, gram, step, words).collect())
    want = sorted((d, *x[1:3], x[4]) for (d, *_), x in zip(rows, suffixes.brute_force([(t or "").encode() for _, t, *_ in rows], length, words), strict=True))
    assert got == want


@pytest.mark.parametrize("name", ["CROWDED", "COMBINED", "SEGMENT"])
def test_repeats_of_split_buckets_and_small_tasks(docs, rows, monkeypatch, name):
    monkeypatch.setattr(suffixes, name, 2000 if name == "SEGMENT" else 2)
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"], r["n_repeated_words"]) for r in suffixes.remove_repeats(docs, 60, 8, 20, 12).collect())
    want = sorted((d, *x[1:3], x[4]) for (d, *_), x in zip(rows, suffixes.brute_force([(t or "").encode() for _, t, *_ in rows], 60, 12), strict=True))
    assert got == want


def test_passes_keep_what_is_equal_in_all_digits():
    rng = np.random.default_rng(0)
    digits = [rng.integers(0, 5, 400) for _ in range(4)]
    seen = defaultdict(list)
    for i, key in enumerate(zip(*digits, strict=True)):
        seen[key].append(i)
    assert sorted(suffixes.repeated(digits)) == sorted(i for x in seen.values() if len(x) > 1 for i in x)
    assert not len(suffixes.repeated([np.zeros(0, np.int64)] * 2))


def test_long_documents_are_cut_in_segments_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(4)
    letters = rng.integers(97, 123, 30000).astype(np.uint8).tobytes().decode()
    texts = [(1, letters + letters[100:9000]), (2, letters[5000:7000])]
    monkeypatch.setattr(suffixes, "SEGMENT", 4000)
    data = np.frombuffer(texts[0][1].encode(), np.uint8)
    whole = {(int(s - e[0] + b), int(c)) for p, e, b in suffixes.segments(data, np.array([0, len(data)]), 400) for s, c in zip(*suffixes.runs(p, e, 400, 32, 112)[3:], strict=True)}
    covered = sorted(x for s, c in whole for x in range(s, s + c))
    assert covered == list(range(len(data) - 399))
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in suffixes.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert got == sorted((d, x[1], x[2]) for (d, _), x in zip(texts, suffixes.brute_force([t.encode() for _, t in texts]), strict=True))


def line_reference(rows, least_chars=40, least_docs=5):
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    held = defaultdict(list)
    for d, t, *_ in rows:
        for key in {x.strip(strip).translate(LOWER) for x in (t or "").split("\n")}:
            if len(key) >= least_chars:
                held[key].append(d)
    out = []
    for d, t, *_ in rows:
        all_ = (t or "").split("\n")
        keys = [x.strip(strip).translate(LOWER) for x in all_]
        kept = [x for x, k in zip(all_, keys, strict=True) if not (len(held[k]) >= least_docs and max(held[k]) != d)]
        out.append((d, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("broadcast_bytes", [lines.BROADCAST_BYTES, 0])
def test_lines_go_but_from_the_largest_id(docs, rows, broadcast_bytes):
    got = lines.dedup_lines(docs, least_chars=10, least_docs=3, broadcast_bytes=broadcast_bytes)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in got.collect()) == line_reference(rows, 10, 3)


@pytest.mark.parametrize("broadcast_bytes", [lines.BROADCAST_BYTES, 0])
def test_lines_in_many_shards(docs, rows, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(lines, "SHARD_KEYS", 1)
    monkeypatch.setattr(lines, "PROBES", 2)
    got = lines.dedup_lines(docs, least_chars=10, least_docs=3, broadcast_bytes=broadcast_bytes)
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in got.collect()) == line_reference(rows, 10, 3)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        index = PerfectHash(keys)
        assert sorted(index(keys).tolist()) == list(range(len(keys)))
        others = rng.integers(0, 2**63, 500).astype(np.uint64)
        assert (index(others) < max(1, len(keys))).all()


def thue_morse(n, a, b):
    """A string and its complement collide in every polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_strings_that_fool_polynomials_stay_apart(spark, n):
    x, y = thue_morse(n, "a", "b")
    docs = spark.createDataFrame([(1, x), (2, x), (3, x), (4, y), (5, y)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similar(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert [r["n_dropped"] for r in lines.dedup_lines(docs).collect()] == [0] * 5


def test_empty_tables(empty):
    assert jaccard.similar(empty).count() == 0
    assert suffixes.remove_repeats(empty).count() == 0
    assert lines.dedup_lines(empty).count() == 0


def test_clashing_columns(docs):
    from pyspark.sql import functions as F

    more = docs.withColumn("n_lines", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("bucket", F.lit(None)).withColumn("row_key", F.lit(2)).withColumn("n", F.lit("y"))
    assert lines.dedup_lines(more).count() == docs.count()
    assert jaccard.similar(more).count() == docs.count()
    assert suffixes.remove_repeats(more).count() == docs.count()
