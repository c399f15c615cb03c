"""Media columns, tokens, scores, quality, leaks, archives and url filters."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import bigrams, jpeg, leaks, media, pieces, quality, urls, warc
from lodestone.llm.kernels import Rolling, hashed_words, slices, span_hashes, text_buffers, word_spans

from .test_pairs_and_repeats import thue_morse

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_words_and_hashes_don_t_depend_on_the_batch(rows):
    texts = [t for _, t, *_ in rows]
    data, at = text_buffers(pa.array(texts))
    hashes, start, end, first = hashed_words(data, at)
    found = [data[a:b].tobytes().decode().translate(LOWER) for a, b in zip(start, end, strict=True)]
    assert found == [w for t in texts for w in words_of(t)]
    assert len(set(zip(found, hashes.tolist(), strict=True))) == len(set(found)) == len(set(hashes.tolist()))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for most in (1, 50, 10**9):
        again = np.concatenate([hashed_words(d, a)[0] for _, d, a in slices([batch], most=most)])
        assert (again == hashes).all()


def test_equal_spans_have_equal_hashes():
    rng = np.random.default_rng(9)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    for size in (1, 2, 3, 7, 8, 9, 16, 17, 600):
        start = np.arange(len(data) - size + 1)
        texts = [data[i : i + size].tobytes() for i in start]
        by_words = np.repeat(np.arange(len(data)), 1)[: len(data)].astype(np.uint64) % np.uint64(97)
        for hashes, kinds in ((span_hashes(data, start, start + size), texts), (Rolling(data, (size, 600)).all(size), texts), (Rolling(by_words, (size,))(start, size), [by_words[i : i + size].tobytes() for i in start])):
            assert len(set(hashes.tolist())) == len(set(kinds)) == len(set(zip(hashes.tolist(), kinds, strict=True)))
    rolling = Rolling(data, (5, 40))
    assert (rolling(np.array([3, 9]), np.array([5, 40])) == np.array([rolling.all(5)[3], rolling.all(40)[9]])).all()
    assert word_spans(np.zeros(0, np.uint8), np.zeros(1, np.int64))[0].size == 0
    assert span_hashes(np.zeros(0, np.uint8), np.zeros(2, np.int64), np.zeros(2, np.int64)).size == 2


def test_scores_and_leaks_of_strings_that_fool_polynomials(spark):
    x, y = thue_morse(1024, "a", "b")
    docs = spark.createDataFrame([(1, "p " + x), (2, "p " + y)], "doc_id long, text string")
    assert [r["n_backoff"] for r in bigrams.score_documents(docs).collect()] == [1, 1]
    items = spark.createDataFrame([(1, "p " + x)], "item_id long, text string")
    assert [r["doc_id"] for r in leaks.find_leaks(docs, items).collect()] == [1]


def test_media_columns_keep_every_byte(docs, rows):
    got = sorted(media.media_features(media.store_media(docs)).collect(), key=lambda r: (r["doc_id"], r["payload_sha256"]))
    want = []
    for d, t, *_ in rows:
        raw = (t or "").encode()
        full = raw + b"\0" * ((-len(raw)) % 64 or (0 if raw else 64))
        want.append((d, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])))
    assert [tuple(r)[:5] for r in got] == sorted(want, key=lambda x: (x[0], x[3]))
    same = {}
    for r in got:
        assert same.setdefault(r["payload_sha256"], (r["media_sha256"], r["feature"], r["media_bytes"])) == (r["media_sha256"], r["feature"], r["media_bytes"])


def test_jpeg_round_trip_of_all_values_runs_and_tables():
    rng = np.random.default_rng(0)
    payloads = [rng.integers(0, 256, 64 * n).astype(np.uint8) for n in (1, 2, 3, 4, 5, 17, 200)]
    payloads += [np.full(64 * 9, 128, np.uint8), np.where(rng.random(6400) < 0.95, 128, rng.integers(0, 256, 6400)).astype(np.uint8), np.full(64, 255, np.uint8)]
    files = jpeg.encode(payloads)
    for p, f, (parsed, blocks) in zip(payloads, files, jpeg.decode(files), strict=True):
        used = int.from_bytes(parsed.comment, "big")
        assert ((blocks[:used] + 128).astype(np.uint8).ravel() == p).all()
        assert f[:2] == b"\xff\xd8" and f[-2:] == b"\xff\xd9" and not blocks[used:].any()
        small = jpeg.thumbnail(parsed, blocks)
        assert (small.ravel()[:used] == p[::64]).all() and len(jpeg.thumbnail_hash(small)) == 16


def test_jpeg_without_restart_markers(monkeypatch):
    payload = np.random.default_rng(1).integers(0, 256, 64 * 50).astype(np.uint8)
    monkeypatch.setattr(jpeg, "INTERVAL", 65535)
    file = jpeg.encode([payload])[0].replace(b"\xff\xdd\x00\x04\xff\xff", b"\xff\xdd\x00\x04\x00\x00")
    parsed, blocks = jpeg.decode([file])[0]
    assert parsed.interval == 0 and ((blocks[:50] + 128).astype(np.uint8).ravel() == payload).all()


@pytest.mark.parametrize("file", [b"", b"GIF89a", b"\xff\xd8\xff\xc2\x00\x0b\x08\x00\x08\x00\x08\x01\x01\x11\x00"])
def test_jpeg_refuses_what_it_can_t_read(file):
    with pytest.raises(ValueError, match="JPEG|broken|baseline"):
        jpeg.decode([file])


#: Model files merge repeated parts, so a few bytes at the end turn a model into another: of unigrams, and one that
#: squeezes spaces and marks no beginning.
VARIANTS = {"merges": b"", "unigrams": b"\x12\x02\x18\x01", "squeezed": b"\x1a\x04\x18\x00\x20\x01", "squeezed unigrams": b"\x12\x02\x18\x01\x1a\x04\x18\x01\x20\x01"}


def plain_model(pieces_, byte_fallback):
    """A small unigram model file: unknown, pieces with scores, and the bytes."""
    field = lambda n, x: bytes([n << 3 | 2]) + (bytes([len(x)]) if len(x) < 128 else bytes([len(x) & 127 | 128, len(x) >> 7])) + x
    piece = lambda t, s, k: field(1, field(1, t.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, k]))
    out = piece("<unk>", 0, 2) + b"".join(piece(t, s, 1) for t, s in pieces_)
    out += b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256)) if byte_fallback else b""
    trainer = b"\x18\x01" + (b"\x98\x02\x01" if byte_fallback else b"")
    return out + field(2, trainer) + field(3, field(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")


@pytest.mark.parametrize("kind", [*VARIANTS, "small", "small without bytes", "across words"])
def test_pieces_are_the_library_s(rows, kind):
    spm = pytest.importorskip("sentencepiece")
    if kind in VARIANTS:
        with open(pieces.default_model(), "rb") as f:
            raw = f.read() + VARIANTS[kind]
        if "unigrams" in kind:  # a cost of a thousand millions would swallow all others in the library's 32-bit sums
            raw = raw.replace(struct.pack("<f", -1e9), struct.pack("<f", -4e4))
    else:
        more = [("g▁A", -1.5), ("e▁the", -2.0)] if kind == "across words" else []
        raw = plain_model([("▁", -3.0), ("t", -4.0), ("th", -4.25), ("the", -5.5), ("▁the", -5.0), ("e", -3.5), ("h", -4.5), ("i", -4.0), ("n", -4.0), ("g", -4.0), ("ing", -6.0), ("in", -5.75), ("A", -5.0), ("é", -7.0), ("▁A", -4.5), ("same", -8.0), ("w", -3.0), (".", -2.0), (".e", -9.0), *more], kind != "small without bytes")
    mine, theirs = pieces.Transducer(raw), spm.SentencePieceProcessor(model_proto=raw)
    rng = np.random.default_rng(3)
    alphabet = list("abcdeé ñß  \n\t漢字🙂▁.,!0123 ABthing'\"()") + ["the", " of", "²."]
    texts = [t or "" for _, t, *_ in rows if len(t or "") < 3000] + ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)] + [" " * n + "a" for n in range(40)]
    for t in texts:
        ids = mine.encode(t)
        assert ids == theirs.encode(t), repr(t)
        assert mine.decode(ids) == theirs.decode(ids)
    data, at = text_buffers(pa.array(texts))
    ids, ends = mine.encode_batch(data, at)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [mine.encode(t) for t in texts]


def test_ids_out_of_range_raise():
    with open(pieces.default_model(), "rb") as f:
        model = pieces.Transducer(f.read())
    for ids in ([-1], [5, 32000]):
        with pytest.raises(ValueError, match="range"):
            model.decode(ids)


def test_pieces_of_documents(docs, rows):
    out = pieces.decode_pieces(pieces.encode_pieces(docs.withColumn("ids", F.lit("old")))).collect()
    assert sorted((r["doc_id"], r["decoded"]) for r in out) == sorted((d, (t or "")) for d, t, *_ in rows)
    assert all(len(r["ids"]) == 0 for r in out if not r["text"])


def test_encoding_and_decoding_are_one_pass(spark, docs, tmp_path):
    """A task of the query and of the pipeline's stage holds one Python worker, and rows are those of two passes."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    given = docs.withColumn("ids", F.lit("old")).withColumn("decoded", F.lit("old"))
    one = pieces.round_trip(given)
    two = pieces.decode_pieces(pieces.encode_pieces(given))
    assert sorted(one.columns) == sorted(two.columns)
    key = lambda df: sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect())
    assert key(one) == key(two)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert plan(pieces.op5_sentencepiece(spark, str(tmp_path))).count("MapInArrow") == 1
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    assert plan(corpus_pipeline.tokens_stage(spark, docs, str(tmp_path))).count("MapInArrow") == 1


@pytest.mark.parametrize("end", [b"\x12\x02\x18\x03", b"\x1a\x03\x12\x01x", b"\x0a\x06\x0a\x02zz\x18\x04"])
def test_other_models_are_refused(end):
    with pytest.raises(ValueError, match="only"):
        pieces.Transducer(plain_model([("a", -1.0)], True) + end)


def score_reference(rows):
    texts = [(d, words_of(t)) for d, t, *_ in rows]
    one, two = Counter(w for _, ws in texts for w in ws), Counter(p for _, ws in texts for p in zip(ws, ws[1:], strict=False))
    total = sum(one.values())
    micro = lambda x: int(np.rint(math.log10(x) * 1e6))
    out = []
    for d, ws in texts:
        score = backoffs = 0
        for v, w in zip([None, *ws], ws, strict=False):
            if v is None:
                score += micro(one[w]) + round(-math.log10(total) * 1e6)
            elif two[v, w] >= 2:
                score += micro(two[v, w] / one[v])
            else:
                backoffs += 1
                score += micro(one[w]) + round(math.log10(0.4 / total) * 1e6)
        out.append((d, len(ws), backoffs, score))
    return sorted(out)


def test_scores_are_those_of_plain_counts(docs, rows):
    assert sorted(map(tuple, bigrams.score_documents(docs).collect())) == score_reference(rows)


def test_scores_of_many_small_slices(docs, rows, monkeypatch):
    monkeypatch.setattr(bigrams, "BUCKET_BYTES", 1 << 20)
    monkeypatch.setattr(bigrams, "PAIR_SLICE", 500)
    assert len(bigrams.hot_words(docs, 128)[0]) >= 2
    assert sorted(map(tuple, bigrams.score_documents(docs).collect())) == score_reference(rows)


def test_leaks_are_those_of_all_windows(spark, docs, rows):
    source = [t for _, t, *_ in rows[:30] if t and len(t.split()) > 25]
    items = [(i, " ".join(t.split()[3:22])) for i, t in enumerate(source)] + [(100, None), (101, ""), (102, "one"), (103, source[0]), (103, source[1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r[0], r[1], round(r[2], 9), r[3], r[4]) for r in leaks.find_leaks(docs, bench).collect()}
    small = [(d, t) for d, t, *_ in rows if t is None or len(t) < 2000]
    want = {(a, b, round(c, 9), e, f) for a, b, c, e, f in leaks.brute_force(small, items)}
    ids = {d for d, _ in small}
    assert {x for x in got if x[0] in ids} == want and want
    kept = leaks.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, *_ in rows} - {x[0] for x in got}


def test_items_of_few_words_are_found_in_longer_documents(spark, docs):
    texts = ["x Alpha beta  gamma delta y alpha beta gamma delta z", "alpha", "one alpha beta", "beta alpha gamma", None, "w " * 9 + "beta gamma"]
    items = [(1, "alpha beta gamma DELTA"), (2, "alpha beta"), (3, "beta gamma"), (3, "alpha"), (4, "alpha"), (5, None), (6, "one alpha beta"), (7, "z z")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, leaks.find_leaks(frame, bench).collect()))
    plain = [(" ".join((t or "").lower().split()).split(), d) for d, t in enumerate(texts)]
    want = []
    for item, t in items:
        asked = (t or "").lower().split()
        for words, d in plain:
            at = [i for i in range(len(words) - len(asked) + 1) if asked and words[i : i + len(asked)] == asked]
            want += [(d, item, 1.0, at[0], len(asked))] if at else []
    assert got == sorted(want) and len(got) > 10
    assert set(got) == leaks.brute_force(list(enumerate(texts)), items)
    assert [r["doc_id"] for r in leaks.drop_leaks(frame, bench).collect()] == [4]


def test_leaks_with_items_in_parts(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(f"oak{i + j}" for j in range(9))) for i in range(5)], "item_id long, text string")
    more = docs.unionByName(spark.createDataFrame([(700, "x " + " ".join(f"oak{3 + j}" for j in range(9)) + " y")], "doc_id long, text string"), allowMissingColumns=True)
    monkeypatch.setattr(leaks, "ITEMS", 2)
    assert [(r[0], r[1]) for r in leaks.find_leaks(more, bench).collect()] == [(700, 3)]
    assert leaks.drop_leaks(more, bench).count() == docs.count()


def test_multi_index_finds_all_within_the_radius(monkeypatch):
    rng = np.random.default_rng(5)
    prints = np.concatenate((rng.integers(0, 2**63, 300).astype(np.uint64), np.zeros(40, np.uint64)))
    queries = prints[:50].copy()
    for _ in range(9):
        queries ^= np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)
    queries = np.append(queries, np.uint64(3))
    distance = np.bitwise_count(queries[:, None] ^ prints[None, :])
    want = sorted(zip(*(x.tolist() for x in np.nonzero(distance <= leaks.RADIUS)), strict=True))
    for most in (leaks.PAIRS, 7):
        monkeypatch.setattr(leaks, "PAIRS", most)
        parts = list(leaks.MultiIndex(prints).search(queries))
        assert sorted(x for q, f in parts for x in zip(q.tolist(), f.tolist(), strict=True)) == want and len(want) >= 60
    assert sum(np.diff(b)[v] for b in leaks.MultiIndex(prints[:300]).begin for v in (0, 77, 200)) < 0.2 * 3 * 300  # the buckets prune


def test_windows_at_the_threshold_are_all_found(spark):
    """Recall over windows of every distance, and what the multi-index alone would have found of them."""
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(60)]
    items, docs = [], []
    for i in range(60):
        n = int(rng.integers(5, 60))
        words = [vocabulary[j] for j in rng.integers(0, 60 if i % 3 else 3, n)]
        items.append((i, " ".join(words)))
        for k in range(4):
            copy = list(words)
            for _ in range(k):
                copy[int(rng.integers(0, n))] = vocabulary[int(rng.integers(0, 60))]
            pad = [vocabulary[j] for j in rng.integers(0, 60, int(rng.integers(0, 30)))]
            docs.append((len(docs), " ".join([*pad, *copy, *pad[::-1], *(copy if k == 2 else [])])))
    items += [(200, items[3][1]), (None, items[4][1])]
    got = sorted((r[0], r[1] is None, r[1] or 0, round(r[2], 9), r[3], r[4]) for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    want = sorted((a, b is None, b or 0, round(c, 9), e, f) for a, b, c, e, f in leaks.brute_force(docs, items))
    assert got == want
    near = [x for x in want if x[3] < 1]
    assert len(near) > 20


def swept(text, items, size=5, least=0.8):
    """For each item the best similarity of its shingles, as a multiset, with those of any window of its length: a sweep
    of whole windows, apart from the operator. All items are of one length. Only windows that have enough shingles of any
    item are compared, with all items at once."""
    words = text.split()
    run = lambda ws: [" ".join(ws[i : i + size]) for i in range(len(ws) - size + 1)]
    each = [run(t.split()) for _, t in items]
    n = len(each[0])
    number = {s: i for i, s in enumerate(sorted({s for x in each for s in x}))}
    counts = np.zeros((len(items), len(number)), np.int32)
    for i, x in enumerate(each):
        np.add.at(counts[i], [number[s] for s in x], 1)
    ids = np.array([number.get(s, -1) for s in run(words)])
    known = np.concatenate(([0], np.cumsum(ids >= 0)))
    best = np.zeros(len(items))
    seen = set()
    for w in np.flatnonzero(known[n:] - known[:-n] >= 2 * n * least / (1 + least) - 1e-9):
        window = ids[w : w + n]
        key = tuple(sorted(window[window >= 0]))
        if key not in seen:
            seen.add(key)
            which, have = np.unique(key, return_counts=True)
            both = np.minimum(counts[:, which], have).sum(axis=1)
            best = np.maximum(best, both / (2 * n - both))
    return {items[i][0]: best[i] for i in np.flatnonzero(best >= least - 1e-12)}


def test_a_very_long_text_with_many_items_that_share_words():
    rng = np.random.default_rng(13)
    vocabulary = [f"w{i}" for i in range(40)]
    template = [vocabulary[j] for j in rng.integers(0, 40, 40)]
    items = []
    for i in range(3000):
        words = list(template)
        words[i % 40] = vocabulary[int(rng.integers(0, 40))]
        items.append((i, " ".join(words)))
    text = " ".join(" ".join(template if rng.random() < 0.3 else [vocabulary[j] for j in rng.integers(0, 40, 40)]) for _ in range(2500))
    index = leaks.Items(items)
    data, at = text_buffers(pa.array([text]))
    words, _, _, first = hashed_words(data, at)
    assert first[-1] == 100_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    found = [x for _, out in leaks._found([batch], index) for x in out[0]]
    want = swept(text, items)
    assert 0 < len(want) < 3000 and {x[0]: round(x[1], 9) for x in found} == {k: round(v, 9) for k, v in want.items()}


def test_quality_learns_junk_passages(spark):
    rng = np.random.default_rng(6)
    good = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n)) + "."
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = good(90) + (" BUY!! NOW!! " * 20 if bad else "") + good(60)
        rows.append((i, text))
        labels.append((i, int(not bad)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.score_quality(docs, quality.fit(docs, known)).withColumn("held", quality.held_out("doc_id")).collect()
    held = [(r["predicted"], labels[r["doc_id"]][1]) for r in out if r["held"]]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_quality_learns_from_all_passages(spark, monkeypatch):
    texts = [" ".join(f"{'junk!!' if i // quality.PASSAGE == 33 else 'word'}{i}" for i in range(n)) for n in (4010, 2600, 30, 0)]
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][: len(texts)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    given = []
    monkeypatch.setattr(quality, "train", lambda bags, labels: given.extend(bags))
    quality.fit(docs, spark.createDataFrame([(d, i % 2) for i, d in enumerate(ids)], "doc_id long, quality int"))
    assert [len(b.shares) for b in given] == [101, 65, 1, 1]
    for bag, text in zip(given, texts, strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        want = quality.features(raw, np.array([0, len(raw)]))
        assert all(np.array_equal(getattr(bag, k), getattr(want, k)) for k in ("shares", "bounds", "first", "rows"))


def test_quality_gradients_are_right():
    rng = np.random.default_rng(7)
    bags = []
    for n in (1, 3, 2):
        words = rng.integers(0, 4, n)
        bags.append(quality.Bags(rng.normal(size=(n, quality.N_FEATURES)), np.array([0, n]), np.concatenate(([0], np.cumsum(words))), rng.integers(0, 5, (words.sum(), 2)).astype(np.uint16)))
    y = np.array([1.0, 0.0, 1.0])
    model, all_ = quality.train(bags, y), quality.Bags.of(bags)
    loss = lambda: -np.mean(y * np.log(model.forward(all_)[-1]) + (1 - y) * np.log(1 - model.forward(all_)[-1]))
    for key, grad in model.gradients(all_, y).items():
        at = (int(all_.rows[0, 0]), 1) if key == "E" else (0,) * model.weights[key].ndim
        old = model.weights[key][at]
        model.weights[key][at] = old + 1e-6
        up = loss()
        model.weights[key][at] = old - 1e-6
        down = loss()
        model.weights[key][at] = old
        assert abs((up - down) / 2e-6 - grad[at]) < 1e-6


def test_quality_scores_are_those_of_plain_loops(spark, docs, rows):
    """Passages, words, projection, attention and score of every document again, one number at a time."""
    rng = np.random.default_rng(14)
    n = quality.N_FEATURES
    shapes = {"W": (n + 16, 32), "b": (32,), "V": (32, 16), "U": (32, 16), "w": (16,), "c": (32,), "d": (1,), "E": (2 * quality.BUCKETS + 1, 16)}
    w = {k: rng.normal(0, 0.3, s) for k, s in shapes.items()}
    model = quality.Model(mean=rng.normal(size=n), scale=rng.random(n) + 0.5, weights=w)
    got = {}
    for r in quality.score_quality(docs, model).collect():
        got.setdefault((r["doc_id"], r["text"]), set()).add(r["score"])
    hash_of = lambda x: int(span_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x.encode())]))[0])
    count = lambda s, f: sum(map(f, s))
    kinds = [lambda b: 65 <= b <= 90, lambda b: 97 <= b <= 122, lambda b: 48 <= b <= 57, lambda b: b >= 128, lambda b: 32 < b < 127 and not chr(b).isalnum(), *[lambda b, c=c: b == ord(c) for c in "!?.,|:;-_/"], lambda b: chr(b) in "#$%&*@~^+=<>", lambda b: chr(b) in "()[]{}\"'"]
    for (d, text), scores in got.items():
        if len(text or "") > 20000:
            continue
        found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
        parts = [found[i : i + quality.PASSAGE] for i in range(0, len(found), quality.PASSAGE)] or [[]]
        h, logits, before = [], [], None
        for part in parts:
            x, mean = [0.0] * n, np.zeros(16)
            if part:
                raw = [t.encode() for _, _, t in part]
                size, k = sum(map(len, raw)), len(raw)
                low = [t.translate(LOWER) for _, _, t in part]
                x = [sum(count(b, f) for b in raw) / size for f in kinds]
                lines = []
                for i, (a, _, _) in enumerate(part):
                    last = part[i - 1][1] if i else before
                    lines.append(text[last:a].count("\n") if last is not None else 0)
                avg = size / k
                signs = [kinds[4](b[-1]) for b in raw]
                x += [math.log1p(k), avg, math.sqrt(max(sum(len(b) ** 2 for b in raw) / k - avg**2, 0)), sum(count(b, kinds[0]) >= len(b) / 2 for b in raw) / k, sum(kinds[0](b[0]) for b in raw) / k, sum(a == b for a, b in zip(low, low[1:], strict=False)) / k, len(set(low)) / k, max(Counter(low).values()) / k, sum(lines) / k, sum(signs) / k, sum(len(b) <= 3 for b in raw) / k]
                for i, t in enumerate(low):
                    mean += w["E"][hash_of(t) % quality.BUCKETS] / k
                    if i + 1 < k:
                        pair = np.array([(hash_of(t) * 3 + hash_of(low[i + 1])) % 2**64], np.uint64)
                        from lodestone.llm.kernels import mix

                        mean += w["E"][quality.BUCKETS + 1 + int(mix(pair)[0]) % quality.BUCKETS] / k
                    else:
                        mean += w["E"][quality.BUCKETS] / k
                before = part[-1][1]
            z = np.concatenate(((np.float32(x) - model.mean) / model.scale, mean))
            hidden = [math.tanh(sum(z[i] * w["W"][i, j] for i in range(len(z))) + w["b"][j]) for j in range(32)]
            gate = [math.tanh(np.dot(hidden, w["V"][:, j])) / (1 + math.exp(-np.dot(hidden, w["U"][:, j]))) for j in range(16)]
            h.append(hidden)
            logits.append(math.exp(np.dot(gate, w["w"])))
        bag = sum(a / sum(logits) * np.array(x) for a, x in zip(logits, h, strict=True))
        want = 1 / (1 + math.exp(-(np.dot(bag, w["c"]) + w["d"][0])))
        assert len(scores) == 1 and abs(scores.pop() - want) < 1e-5, (d, text)


def test_labels_without_documents_take_no_place(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, "good plain words here" if i % 2 else "BUY!! NOW!! $$$ BUY!!") for i in ids], "doc_id long, text string")
    ghosts = spark.range(1000, 300_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels = ghosts.unionByName(spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int"))
    model = quality.fit(docs, labels, most_docs=300)
    assert model.constant is None
    assert all(r["predicted"] == r["doc_id"] % 2 for r in quality.score_quality(docs, model).collect())


def test_quality_without_labels_or_of_one_kind(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs, none)
    assert model.constant == 0.5
    out = quality.score_quality(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    ones = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert 0.5 < quality.fit(docs, ones).constant < 1


PAGES = [(1, "http://A.B.net/x", "p" * 1200), (2, "https://net/", "p" * 1200), (3, None, None), (4, "no scheme", ""), (5, "http://example.NET/en/q?x#y", "short"), (6, "x://u.example.net/en", "short"), (7, "http://example.com/de/#a", "q" * 5000), (7, "http://example.com/de/#a", "q" * 5000), (8, "http://fr.example.org/fr/", "é" * 800), (9, "http://xnet/", "p" * 1200), (10, "http://a.net?q", None), (11, "http://notexample.com/de/", "z"), (12, "http://", "r")]


def test_url_filters(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string").withColumn("key", F.lit(1))
    for parts in (None, 3, 40):
        got = urls.filter_urls(pages, rules, parts=parts).collect()
        want = []
        for i, url, _ in PAGES:
            rest = url.split("://", 1)[1] if url and "://" in url else ""
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = host.translate(LOWER)
            fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
            want.append((i, host, path, *max(fits, key=lambda x: len(x[0]), default=(None, "allow"))))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_url_filters_nested_rules_and_none(spark):
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate((h, p) for h in ("a.com", "x.a.com", "y.x.a.com", "b.com", "") for p in ("", "/", "/p", "/p/q", "/p/qr/s"))], "page_id long, url string")
    rules = [("com", "/", "block"), ("a.com", "/p", "allow"), ("a.com", "/p/q", "block"), ("x.a.com", "/", "allow"), ("x.a.com", "/p/qr", "block"), ("a.com", "/p", "block"), ("", "/p/q", "allow")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), parts=7).collect()}
    for r in pages.collect():
        rest = r["url"].split("://", 1)[1]
        host, path = (rest.split("/", 1)[0], "/" + rest.split("/", 1)[1]) if "/" in rest else (rest, "")
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[r["page_id"]] == (max(fits)[3:] if fits else (None, "allow"))
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in urls.filter_urls(pages, none, default="block").collect()} == {"block"}
    assert urls.filter_urls(pages.filter("page_id < 0"), none).count() == 0


@pytest.mark.parametrize("chunk_bytes", [warc.CHUNK_BYTES, 700])
def test_archives_read_back(spark, chunk_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    chunks = warc.write_archive(pages, chunk_bytes=chunk_bytes).persist()
    got = sorted(map(tuple, warc.read_archive(chunks).collect()), key=str)
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max(i, top.get(h or "", -1))
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and top[h] != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    assert got == sorted(want, key=str)
    assert chunks.agg(F.max(F.length("data"))).first()[0] <= chunk_bytes
    file = b"".join(warc.warc_bytes(chunks))
    at = n = 0
    while at < len(file):
        end = file.index(b"\r\n\r\n", at)
        fields = warc.parse_header(file[at:end].decode() + "\r\n\r\n")
        at = end + 4 + int(fields["content-length"])
        assert fields["version"] == "WARC/1.1" and file[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == len(PAGES)
    chunks.unpersist()


def test_broken_archives_raise(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    bad = warc.write_archive(pages).withColumn("data", F.when(F.col("record_id") == 8, F.lit(b"changed")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(bad).count()


def test_empty_tables_of_text_operators(spark, empty):
    assert media.media_features(media.store_media(empty)).count() == 0
    assert pieces.decode_pieces(pieces.encode_pieces(empty)).count() == 0
    assert bigrams.score_documents(empty).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert leaks.find_leaks(empty, bench).count() == 0 and leaks.drop_leaks(empty, bench).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(warc.write_archive(pages)).count() == 0
    assert quality.score_quality(empty, quality.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))).count() == 0


def test_clashing_columns_of_text_operators(spark, docs, rows):
    names = ("bucket", "slice", "row", "score", "item_id", "words", "payload", "media", "key", "n_words")
    more = docs.select("*", *[F.lit("x").alias(n) for n in names])
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(media.media_features(media.store_media(more))) == plain(media.media_features(media.store_media(docs)))
    assert plain(bigrams.score_documents(more)) == plain(bigrams.score_documents(docs))
    bench = spark.createDataFrame([(1, " ".join(rows[0][1].split()[:30]))], "item_id long, text string")
    assert plain(leaks.find_leaks(more, bench.withColumn("doc_id", F.lit("y")))) == plain(leaks.find_leaks(docs, bench))
    assert leaks.drop_leaks(more, bench).columns == more.columns


def test_places_among_many_bounds(spark):
    from collections import namedtuple

    bound = namedtuple("bound", "k s")
    for n in (0, 1, 2, 3, 10, 17):
        bounds = [bound(f"k{i // 2:02d}", i % 2) for i in range(n)]
        frame = spark.createDataFrame([(f"k{i // 2:02d}", i % 2) for i in range(-2, n + 3)], "k string, s int")
        got = frame.select("k", "s", urls.places_before(bounds, F.struct("k", "s")).alias("p")).collect()
        assert [r["p"] for r in got] == [sum((b.k, b.s) <= (r["k"], r["s"]) for b in bounds) for r in got]


def test_null_ids(spark, docs, rows):
    from lodestone.llm import jaccard, lines, suffixes

    more = docs.unionByName(spark.createDataFrame([(None, rows[0][1] + " a b c d e f g", "en", "s", 1), (None, None, None, None, None)], docs.schema))
    n = len(rows) + 2
    bench = spark.createDataFrame([(None, rows[0][1])], "item_id long, text string")
    assert jaccard.similar(more).count() == suffixes.remove_repeats(more).count() == lines.dedup_lines(more, 5, 2).count() == n
    assert media.media_features(media.store_media(more)).count() == pieces.encode_pieces(more).count() == n
    scored = bigrams.score_documents(more)
    assert scored.count() == n and scored.filter("doc_id IS NULL").count() == 2
    assert quality.score_quality(more, quality.fit(more, spark.createDataFrame([(None, 1), (1, 0)], "doc_id long, quality int"))).count() == n
    leaks.find_leaks(more, bench).count()
    pages = spark.createDataFrame([(None, "http://a.net/", "x" * 2000), (1, None, "x" * 2000), (None, None, None)], "page_id long, url string, html string")
    assert warc.read_archive(warc.write_archive(pages)).count() == 3
    assert urls.filter_urls(pages, spark.createDataFrame(urls.RULES + [(None, None, "allow")], "host string, path string, verdict string")).count() == 3


def test_requests_of_all_slices_share_a_row(spark):
    """Rows between two buckets don't grow with the slices, and slices have homes in several buckets."""
    docs = spark.sql("SELECT id AS doc_id, concat_ws(' ', transform(sequence(0, 60), x -> concat('w', (x * x * 7 + id * 13) % 997))) AS text FROM range(640)").repartition(32)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    requests = docs.mapInArrow(lambda it: bigrams.explode_pairs(it, 8, none), bigrams.PAIRS).groupBy("bucket").applyInArrow(lambda t: bigrams.score_pairs(t, 8), bigrams.REQUESTS).cache()
    assert 8 < requests.filter("keys IS NOT NULL AND counts IS NULL").count() <= 8 * 8
    assert requests.filter("keys IS NULL").select("bucket").distinct().count() > 4
    requests.unpersist()
