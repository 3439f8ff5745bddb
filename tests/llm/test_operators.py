"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import bpe, common, components, embed_dedup, license_scan, mixing, pii, quality, simhash, suffix_dedup, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "be", "ti", "on", "É", "st"]) for _ in range(rng.randint(1, 3)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 90))) for _ in range(40)]
    texts += texts[:6] + [t.replace("an", "st", 1) for t in texts[:10]]
    texts += [None, "", "  \n\t ", "one", "x " * 6000, "a" * 3000, "\x00nul É 🎉 end"]
    rows = [(i, t, "en", rng.choice(["s1", "s2", "s3", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[3], None, None, 5), (None, None, None, "s1", None), (3, "another text of a repeated id", "en", "s1", 9)]


@pytest.fixture(scope="module")
def rows():
    return _docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _clash(df):
    """Columns named like the operators' own."""
    for c in ("score", "predicted", "n_pii", "ids", "size", "taken", "mix_key", "MIX_SIZE", "fp", "node", "key", "h", "kept_row", "pii_found", "scored_text"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def _key(x):
    return repr([None if v is None or v != v else v for v in x])


def _same(got, want):
    assert sorted(map(_key, got)) == sorted(map(_key, want))


# --- 1 mixing ---


def _mix_brute(rows):
    size = lambda t: len(WORD.findall(t or ""))
    by = {}
    for i, t, _, s, _ in rows:
        by.setdefault(s, []).append((int(hashlib.md5(f"mix-1:{'null' if i is None else i}".encode()).hexdigest()[:15], 16), -1 if i is None else i, size(t), i))
    names = sorted([s for s in by if s is not None]) + [None] * (None in by)
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(x[2] for x in by[s]) for s in names}
    target, left, free = {}, 1.5 * sum(total.values()), set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= 2 * total[s]}
        if not over:
            target |= {s: w[s] * level for s in free}
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= over
    out = []
    for s in names:
        budget = round(target[s])
        full = budget // total[s] if total[s] else 0
        rest = budget - full * total[s]
        for _, _, n, i in sorted(by[s]):
            take = min(n, max(0, rest))
            rest -= n
            out.append((i, n, total[s], round(target[s], 6), full * n + take))
    return out


def test_mix(docs, rows):
    got = mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()]
    _same(got, _mix_brute(rows))


def test_mix_documents_takes_the_budget(docs, rows):
    out = mixing.mix_documents(_clash(docs))
    assert out.columns == _clash(docs).columns
    words = Counter()
    for r in out.collect():
        words[r.source] += len(WORD.findall(r.text))
    want = Counter()
    for (i, n, _, _, taken), s in zip(_mix_brute(rows), [s for s in ["s1", "s2", "s3", None] for r in rows if r[3] == s]):
        want[s] += taken
    assert words == want


def test_mix_ranges_do_not_change_the_cut(docs, monkeypatch):
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    one = sorted(map(_key, mixing.mix(sizes).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    assert sorted(map(_key, mixing.mix(sizes).collect())) == one


# --- 2 suffix dedup ---


def _repeats_brute(rows):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, int)
        for k in range(len(b) - 49):
            f = first[b[k : k + 50]]
            if f is not None and (i is None or f < i):
                gone[k + 1 : k + 51] = 1
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark, docs, rows):
    _same([tuple(r) for r in suffix_dedup.digests(_clash(docs)).collect()], _repeats_brute([r[:2] for r in rows]))


def test_suffix_dedup_periods_and_edges(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(300))
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 200))) + base[(a := rng.randint(0, 250)) : a + rng.randint(0, 90)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["a" * n for n in (49, 50, 51, 400)] + ["ab" * 200, base, base, "é" * 60]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _same([tuple(r) for r in suffix_dedup.digests(df).collect()], _repeats_brute(rows))


def test_suffix_dedup_with_several_gathers_a_block(spark, monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = [base[(a := rng.randint(0, 200)) : a + rng.randint(60, 200)] for _ in range(60)] + [base[20:], base, base, base[5:300]]
    rows = list(enumerate(texts))
    monkeypatch.setattr(suffix_dedup, "GATHER_BYTES", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    _same([tuple(r) for r in suffix_dedup.digests(df).collect()], _repeats_brute(rows))


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_suffix_dedup_with_hot_anchors(spark, monkeypatch, hot):
    """A short boilerplate in many contexts: its anchors' windows are dealt one by one."""
    rng = random.Random(7)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, shared = piece(40), [piece(30) for _ in range(5)]
    rows = [(i, rng.choice(shared) + line + rng.choice(shared) if rng.random() < 0.4 else piece(50) + line + piece(50)) for i in range(80)] + [(200, line * 5)]
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _same([tuple(r) for r in suffix_dedup.digests(df).collect()], _repeats_brute(rows))


def test_suffix_dedup_keeps_anchors_of_many_copies_whole(spark, monkeypatch, tmp_path):
    """Only many contexts make an anchor hot: the copies of one passage, which grow with the table, are one segment a block."""
    rng = random.Random(11)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, passage = piece(40), piece(300)
    rows = [(i, passage) for i in range(150)] + [(200 + i, piece(50) + line + piece(50)) for i in range(100)]
    monkeypatch.setattr(suffix_dedup, "HOT", 60)
    monkeypatch.setattr(suffix_dedup, "scratch", lambda session, name: f"file://{tmp_path}/{name}")
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    _same([tuple(r) for r in suffix_dedup.digests(df).collect()], _repeats_brute(rows))
    anchors, hot = suffix_dedup._anchors(f"file://{tmp_path}/repeats", 0)
    of = lambda text: np.isin(anchors, suffix_dedup.runs(text.encode())[0].view(np.int64))
    assert of(passage).any() and not hot[of(passage)].any()
    assert hot.any()


def test_suffix_dedup_runs_do_not_depend_on_neighbours(monkeypatch):
    rng = random.Random(12)
    texts = [bytes(rng.choice(b"ab \x00\xff") for _ in range(rng.choice([0, 1, 49, 50, 51, 120, 900]))) for _ in range(80)]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    for size in (60, 300, 1 << 15):
        monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", size)
        h, first, last, doc = suffix_dedup.runs_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
        for k, text in enumerate(texts):
            at = doc == k
            assert [x.tolist() for x in (h[at], first[at] - offsets[k], last[at] - offsets[k])] == [x.tolist() for x in suffix_dedup.runs(text)]


def test_lost_verdicts_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        suffix_dedup._part(f"file:{tmp_path}/none", 3, ["h"])


def test_cut_takes_verdicts_in_any_order():
    text = bytes(range(60, 130))
    h, first, last = suffix_dedup.runs(text)
    verdicts = {}
    for g, i, j in zip(h.view(np.int64).tolist(), first.tolist(), last.tolist()):
        name = xxhash.xxh64_intdigest(text[i : j + suffix_dedup.LENGTH])
        verdicts[name] = tuple((g, k, k, 0) for k in reversed(range(j - i + 1))) * 2
    assert suffix_dedup._cut(text, 5, np.sort(h.view(np.int64)), np.zeros(0, np.int64), verdicts) == (b"", 70, 70, 1)


def test_shard_merge_equals_one_sort(monkeypatch):
    rng = random.Random(2)
    segments = list(dict.fromkeys(bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(50, 74))) for _ in range(120)))
    segments += [s[3:60] + b"tail" * 3 for s in segments[:30]]
    segments = list(dict.fromkeys(segments))
    keys = np.array([rng.randint(0, 40) for _ in segments])
    least = {}
    for s, k in zip(segments, keys):
        for i in range(len(s) - 49):
            least[s[i : i + 50]] = min(least.get(s[i : i + 50], 99), int(k))
    want = [[least[s[i : i + 50]] for i in range(len(s) - 49)] for s in segments]
    for size in (500, 5000, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", size)
        assert [x.tolist() for x in suffix_dedup.window_minima(segments, keys)] == want


def test_common_prefixes_of_a_merge():
    texts = [b"banana bandana", b"ananas", b"bandit banana"]
    shards = [suffix_dedup.sorted_suffixes([t]) for t in texts]
    z, prefix = suffix_dedup.merge_shards([s[1] for s in shards], 50)
    at, merged = [0, 0, 0], []
    for k in z:
        merged.append((texts[k] + b"\x00")[shards[k][0][at[k]] :])
        at[k] += 1
    clean = [m.rstrip(b"\x00") for m in merged]
    assert clean[3:] == sorted(clean[3:])
    for a, b, p in zip(clean[3:], clean[4:], prefix[4:]):
        assert p == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# --- 3 WARC ---


def test_warc(spark):
    big, big2 = "<p>" + "x" * 2000, "é" * 700
    rows = [(1, "http://b.example/2", big), (2, "http://a.example/1#f", big), (3, None, big), (3, "http://a.example/1", big), (4, "bad [ url", None), (5, "http://a.example/1", ""), (None, "http://www.b.example:80/2", big2), (None, "u", big2), (7, "u", "short"), (8, "u", "short"), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("mine")).repartition(3)
    history, read = warc.archive(df)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == p and j is not None]
        last = max(same) if len(p) >= 1000 and same else None
        revisit = last is not None and i != last
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    got = read.collect()
    _same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], want)
    assert all(bytes(r.payload) == b"" for r in got if r.record_type == "revisit")
    lines = history.orderBy("part", "at").collect()
    keys = [warc.index_key(x) for x in lines]
    assert len(keys) == len(rows) and keys == sorted(keys)
    inorder = read.orderBy("part", "at").collect()
    assert [(r.page_id, r.payload_digest) for r in inorder] == [(x.page_id, x.payload_digest) for x in lines]
    plain = warc.read_archives(history.select("file").distinct()).collect()
    _same([tuple(r) for r in plain], [tuple(r)[:8] for r in got])


def test_warc_with_many_repeated_payloads(spark, monkeypatch):
    pages = [(i, f"u{i % 7}", "x" * (1000 + i % 5) if i % 3 else "y" * 1500) for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    few = [tuple(r) for r in warc.archive(df, payloads=False)[1].drop("part", "at").collect()]
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    _same([tuple(r) for r in warc.archive(df, payloads=False)[1].drop("part", "at").collect()], few)
    assert sum(r[3] == "response" for r in few) == 6


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a" * 50), (2, "v", "b" * 50)], "page_id long, url string, html string").coalesce(1)
    history, _ = warc.archive(df, f"file://{tmp_path}/w")
    history = history.withColumn("payload_digest", F.lit("0" * 40))
    with pytest.raises(Exception, match="isn't the one of the index"):
        warc.read_history(history).collect()


def test_loser_tree():
    rng = random.Random(4)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted(rng.choices(range(20), k=rng.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


# --- 4 embeddings ---


def _vectors():
    rng = np.random.default_rng(7)
    base = rng.standard_normal((30, 16))
    near = base[:12] + 0.1 * rng.standard_normal((12, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, base[:3], 7.5 * base[:3]]))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1e300] * 16, [1e-300] * 16, [1.0] * 8, [2.0] * 8]
    rows += [(100 + i, v) for i, v in enumerate(odd)]
    return rows + [(5, base[5].tolist()), (None, base[6].tolist()), (None, [3.0] * 5)]


def _vectors_brute(rows):
    units = []
    for _, v in rows:
        good = v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0
        units.append(np.array(v) / np.abs(v).max() if good else None)
    n = len(rows)
    link = [[j for j in range(n) if i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] / np.linalg.norm(units[i]) / np.linalg.norm(units[j]) >= 0.9] for i in range(n)]
    out = []
    for i, (vid, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vid, len(link[i]), c, vid is not None and vid == c))
    return out


@pytest.mark.parametrize("cell", [1024, 8])
def test_embeddings(spark, cell, monkeypatch):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).repartition(3)
    monkeypatch.setattr(embed_dedup.near_links, "__defaults__", (embed_dedup.THRESHOLD, cell, None))
    _same([tuple(r) for r in embed_dedup.near_duplicates(df, recall=0.9999).collect()], _vectors_brute(rows))


@pytest.mark.parametrize("dim", [64, 200])
def test_embedding_recall_at_the_threshold(spark, dim):
    """At shipped settings: pairs of cosine 0.90 to 0.92 among unrelated vectors, none below the threshold."""
    rng = np.random.default_rng(dim)
    u = rng.standard_normal((1500, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.standard_normal((1500, dim))
    w -= (w * u).sum(1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    c = rng.uniform(0.9001, 0.92, 1500)[:, None]
    v = np.concatenate([u, c * u + np.sqrt(1 - c**2) * w, rng.standard_normal((3000, dim))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    links = sum(r.n_links for r in embed_dedup.near_duplicates(df).collect())
    v /= np.linalg.norm(v, axis=1)[:, None]
    truth = int((v @ v.T >= 0.9).sum()) - len(v)
    assert 0.96 * truth <= links <= truth and truth >= 3000


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    u = rng.standard_normal((400, 64))
    u[200:] = u[:200] + 0.4 * u[200:]
    u /= np.linalg.norm(u, axis=1)[:, None]
    plan = (9, 14)
    code, fa, fb = embed_dedup.codes(u, plan)
    assert code.shape == (400, 16)
    a, b, na, nb = embed_dedup.estimates(embed_dedup.signs_of(code, 64, plan), fa, fb, 64, plan)
    error = a @ b.T - u @ u.T
    sigma = np.sqrt((na[:, None] * (1 - (u @ u.T) ** 2 + nb) + nb * (1 - (u @ u.T) ** 2)).clip(0) / 63)
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.005 and (np.abs(error) < embed_dedup.SIGMAS * sigma)[off].mean() > 0.999
    assert abs(error[np.arange(200), np.arange(200, 400)].mean()) < 0.03
    both, variance = (error + error.T) / 2, (sigma**2 + (sigma**2).T) / 2
    assert 0.6 < (both / np.sqrt(variance))[off].std() < embed_dedup.AVERAGED


# --- ids ---

BIG = (1 << 53) + 1


def test_large_ids_beside_nulls(spark):
    """Ids that doubles can't hold stay exact when a null id is in the same batch."""
    texts = [(BIG, "one two three four"), (None, "one two three four"), (BIG + 2, "quite another text of words"), (-BIG, "one two three four five")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    ids = [i for i, _ in texts]
    by = lambda rows, c: sorted((r[c] for r in rows), key=repr)
    got = simhash.near_duplicates(docs).collect()
    assert by(got, "doc_id") == sorted(ids, key=repr) and {r.component_id for r in got if r.doc_id == BIG} <= {BIG, -BIG}
    vectors = spark.createDataFrame([(BIG, [1.0, 2.0]), (None, [1.0, 2.0]), (-BIG, [5.0, 0.0]), (-BIG - 2, [5.0, 0.1])], "vec_id long, embedding array<float>").coalesce(1)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(vectors, recall=0.9999).collect()}
    assert got == {(BIG, 1, BIG, True), (None, 1, BIG, False), (-BIG, 1, -BIG - 2, False), (-BIG - 2, 1, -BIG - 2, True)}
    pages = spark.createDataFrame([(BIG, "u", "x" * 2000), (None, "u", "x" * 2000), (BIG + 2, "v", "x" * 2000), (-BIG, None, None)], "page_id long, url string, html string").coalesce(1)
    history, read = warc.archive(pages)
    want = sorted([BIG, None, BIG + 2, -BIG], key=repr)
    assert by(read.collect(), "page_id") == by(history.collect(), "page_id") == want
    assert {(r.page_id, r.refers_to) for r in read.collect()} == {(BIG, BIG + 2), (None, BIG + 2), (BIG + 2, None), (-BIG, None)}
    files = spark.createDataFrame([(BIG, "a/x", "Released under the MIT License."), (None, "a/y", "Released under the MIT License."), (BIG + 2, "a/z", None)], "id long, path string, text string").coalesce(1)
    assert by(license_scan.scan(files).collect(), "id") == sorted([BIG, None, BIG + 2], key=repr)
    assert by(suffix_dedup.digests(docs).collect(), "doc_id") == sorted(ids, key=repr)


# --- 5 BPE ---


def test_bpe(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t, *_ in rows:
        ids = exact.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    _same([tuple(r) for r in bpe.digests(_clash(docs), path, public_tokenizers.PATTERN).collect()], want)
    back = bpe.decode(docs.sparkSession, F.col("ids"), ranks)
    assert all(bytes(r.b) == (r.text or "").encode() for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("text", back.alias("b")).collect())
    small = bpe.encode(_clash(docs), ranks, public_tokenizers.PATTERN, block=100)
    assert small.columns[-1] == "_ids" and small.where("ids <> 'mine'").count() == 0


@pytest.mark.parametrize("encode", [bpe.encode, bpe.encode_corpus])
def test_bpe_in_small_blocks_and_portions(docs, rows, monkeypatch, encode):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "REPLAY_BYTES", 50)
    got = encode(docs, ranks, public_tokenizers.PATTERN, block=60)
    _same([(*r[:5], tuple(r.ids)) for r in got.collect()], [(*r, tuple(exact.encode_ordinary(r[1] or ""))) for r in rows])


def test_replay_on_random_words():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    words = ["".join(rng.choice(["a", "e", "th", "in", " ", "é", "!", "0", "\n", "你", "ing"]) for _ in range(rng.randint(1, 30))) for _ in range(800)] + ["a" * 999, "!" * 300, " " * 77]
    merges = bpe.Merges(ranks)
    flat, at = bpe.replay([w.encode() for w in words], merges)
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [exact.encode_ordinary(w) for w in words]
    assert [merges.word(w.encode()) for w in words[:50]] == [exact.encode_ordinary(w) for w in words[:50]]


# --- 6 personal data ---


def _luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d)) % 10 == 0


def test_pii(spark):
    card, other = "4465758382889437", "4929348385146306"
    texts = [
        (1, f"mail a.b@x.example.com, card {card} and {card}; not 9807915762804490", 3),
        (2, f"again {card} / {other[:4]} {other[4:8]} {other[8:12]} {other[12:]}", 1 + _luhn(other)),
        (3, "ip 70.23.22.57 and +1 (743) 555-3824 at 333.1.1.1 v1.2.3", 2),
        (4, "2020-02-29 2021-02-29 02/28/1999 13/13/1999 01.02.1850 2500-01-01", 3),
        (5, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ssn 123-45-6789 000-12-1234', 2),
        (6, None, 0), (7, "", 0), (8, "clean text, 12 words or 2024", 0), (9, "x " * 5000 + card, 1), (1, "2020-02-29", 1), (None, card, 1),
    ]
    df = _clash(spark.createDataFrame([x[:2] for x in texts], "doc_id long, text string"))
    got = pii.pseudonymise(df).toPandas()
    assert list(got.columns) == [*df.columns, "_n_pii"]
    by = {t: (o, n) for (_, t, _), o, n in zip(texts, got["text"], got["_n_pii"])}
    assert [by[t][1] for _, t, _ in texts] == [n for *_, n in texts]
    assert by[""][0] == "" and by[None][0] is None
    one = by[texts[-1][1]][0]
    assert len(one) == 16 and _luhn(one) and one != card and one[0] == "4"
    assert by[texts[0][1]][0].count(one) == 2 and one in by[texts[1][1]][0] and by[texts[8][1]][0] == "x " * 5000 + one
    assert "9807915762804490" in by[texts[0][1]][0] and "a.b@" not in by[texts[0][1]][0]
    assert re.fullmatch(r"ip (\d{1,3}\.){3}\d{1,3} and \+1 \(\d{3}\) \d{3}-\d{4} at 333\.1\.1\.1 v1\.2\.3", by[texts[2][1]][0])
    day = by["2020-02-29"][0]
    pd.Timestamp(day)
    assert by[texts[3][1]][0].startswith(f"{day} 2021-02-29 ") and by[texts[3][1]][0].endswith(" 2500-01-01")
    assert re.search(r'token = "[0-9a-f]{40}" ssn \d{3}-\d{2}-\d{4} 000-12-1234', by[texts[4][1]][0])


def test_cards_beside_other_numbers(spark):
    card, spaced, amex = "4111111111111111", "4111 1111 1111 1111", "3782 822463 10005"
    long = next(f"6011 0000 0000 0000 {k:03}" for k in range(1000) if _luhn(f"6011000000000000{k:03}") and not _luhn("6011000000000000"))
    texts = [
        (f"{spaced} 123", [spaced], 1), (f"{spaced} 12/25", [spaced], 1), (f"2 {card}", [card], 1), (f"{card} 4465758382889437", [card, "4465758382889437"], 2),
        ("9807915762804490 233.254.104.120", ["233.254.104.120"], 1), (f"{spaced} 233.254.104.120", [spaced, "233.254.104.120"], 2), (f"{card} a.b@x.example.com", [card, "a.b@x.example.com"], 2),
        (f"{amex} 7", [amex], 1), (long, [long], 1), ("41111111 11111111", ["41111111 11111111"], 1), (f"{spaced.replace(' ', '-')} 123-45-6789", [spaced.replace(" ", "-"), "123-45-6789"], 2), ("1234 5678 9012 3456 789", [], 0),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_pii) for r in pii.pseudonymise(df).collect()}
    assert [got[i][1] for i in range(len(texts))] == [n for *_, n in texts]
    for i, (_, gone, _) in enumerate(texts):
        assert all(x not in got[i][0] for x in gone)
    assert got[0][0].endswith(" 123") and _luhn(got[0][0][:19].replace(" ", "")) and got[2][0].startswith("2 ")


def test_feistel_is_a_permutation(spark):
    n = spark.range(29 * 7)
    out = n.select(pii.feistel(F.col("id") % 29, F.floor(F.col("id") / 29), F.lit(29), F.lit(7), "t").alias("x")).select("x.*").collect()
    assert len({(r.l, r.r) for r in out}) == 29 * 7 and all(0 <= r.l < 29 and 0 <= r.r < 7 for r in out)


# --- 7 quality ---


def test_quality(spark, docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (2, None)], "doc_id long, quality int")
    got = quality.quality(_clash(docs), labels).collect()
    want = []
    for i, t, *_ in rows:
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        c = Counter(windows)
        covered = {k + d for k, x in enumerate(windows) if c[x] > 1 for d in range(3)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(map(t.count, quality.SYMBOLS)), len(lines) - len(set(lines)), len(covered), failed))
    _same([tuple(r)[:7] for r in got], want)
    assert all(not (r.base_failed and r.kept) for r in got)
    free = quality.quality(docs, labels.where("quality > 5")).collect()
    assert all(r.kept != r.base_failed for r in free)


# --- 8 licences ---


@pytest.mark.parametrize("most", [common.BROADCAST_BYTES, 0])
def test_licenses(spark, monkeypatch, most):
    monkeypatch.setattr(common, "BROADCAST_BYTES", most)
    files = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "no notice here"), (3, "a/b/y.py", "some lines of code that are not a notice at all\nLICENSED under the Apache License, Version 2.0.\nmore"),
        (4, "a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3."), (5, "a/b/c/d/z", None), (6, "q/z", ""), (7, None, "plain words"),
        (8, "a/b/c/d/z", "license of no kind known"), (9, "top", "x"), (None, "a/c", "text"), (2, "a/b/x.py", "no notice here"),
    ]
    df = spark.createDataFrame(files, "id long, path string, text string").withColumn("dir", F.lit("mine"))
    got = [(r.id, r.own_license, r.license, r.origin, r.license_dir) for r in license_scan.scan(df).collect()]
    mit, gpl = "MIT", "GPL-3.0"
    _same(got, [
        (1, mit, mit, "own", None), (2, None, mit, "inherited", "a"), (2, None, mit, "inherited", "a"), (3, "Apache-2.0", "Apache-2.0", "own", None), (4, gpl, gpl, "own", None),
        (5, None, gpl, "inherited", "a/b/c"), (6, None, None, "none", None), (7, None, None, "none", None), (8, None, gpl, "inherited", "a/b/c"), (9, None, None, "none", None), (None, None, mit, "inherited", "a"),
    ])


@pytest.mark.parametrize("copies", [1, 400])
def test_license_verdicts_do_not_fall_with_the_corpus(spark, copies):
    mix = ["This work is licensed under the GNU General Public License, version 3."] * 5 + ["Licensed under CC BY-NC 4.0."] * 4 + ["Released under the MIT License."] * 4 + ["Licensed under the Apache License, Version 2.0."] * 4
    notices = ["This module is licensed under the GNU General Public License, version 3.", "This project is licensed under the terms of the MIT license, see README."]
    texts = notices + ["the license fee of our driver was paid under protest to this work of general use"] + mix * copies
    df = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(texts)], "id long, path string, text string")
    got = {r.id: r.own_license for r in license_scan.scan(df).where("id < 3").collect()}
    assert got == {0: "GPL-3.0", 1: "MIT", 2: None}


def test_wrapped_licenses(spark):
    import textwrap

    folder = Path(license_scan.__file__).parent / "licenses"
    read = {f.stem: f.read_text() for f in folder.glob("*.txt")}
    mit = read["MIT"].replace("[year] [copyright holders]", "2021 Somebody Else")
    narrow = "\n\n".join(textwrap.fill(p, 50) for p in mit.split("\n\n"))
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    starred = "/* tool.c\n *\n" + textwrap.fill(gpl, 60, initial_indent=" * ", subsequent_indent=" * ") + "\n */\nint main() { return 0; }\n"
    code = "x = call(1)\n" * 300
    files = [(1, "a/LICENSE", narrow), (2, "a/x.py", None), (3, "b/tool.c", starred), (4, "c/m.py", "".join(f"# {x}\n" for x in narrow.split("\n")) + "\n" + code)]
    files += [(5, "d/lesser.h", starred.replace("General", "Lesser General").replace("version 3", "version 2.1")), (6, "e/essay", "the licence of the old inn was of no use to the men and " * 400)]
    files += [(10 + i, f"full{i}/COPYING", "\n".join(read[k].split("\n"))) for i, k in enumerate(sorted(read))]
    files += [(40, "f/COPYING", read["GPL-3.0"].replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public").replace("29 June", "19 November").replace("13. Use with the GNU Affero", "13. Remote Network Interaction; Use with the GNU"))]
    df = spark.createDataFrame(files, "id long, path string, text string").repartition(4)
    got = {r.id: (r.own_license, r.license, r.origin) for r in license_scan.scan(df).collect()}
    own = lambda k: (k, k, "own")
    want = {1: own("MIT"), 2: (None, "MIT", "inherited"), 3: own("GPL-3.0"), 4: own("MIT"), 5: own("LGPL-2.1"), 6: (None, None, "none"), 40: own("AGPL-3.0")}
    assert got == want | {10 + i: own(k) for i, k in enumerate(sorted(read))}


# --- 9 SimHash ---


def _simhash_brute(rows):
    def fp(t):
        w = (t or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
        sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps = [fp(t) for _, t in rows]
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in range(len(rows)):
                if j not in seen and (fps[k] ^ fps[j]).bit_count() <= 3 and (rows[j][0] is not None or fps[k] == fps[j] or True):
                    seen.add(j)
                    todo.append(j)
        out.append((d, f"{fps[i]:016x}", min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return out


def test_simhash(docs, rows):
    _same([tuple(r) for r in simhash.near_duplicates(_clash(docs)).collect()], _simhash_brute([r[:2] for r in rows]))


@pytest.mark.parametrize("limit", [1024, 6])
def test_fingerprint_links(spark, limit):
    rng = random.Random(6)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = {c for x in centres for c in [x, *(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(60))]} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    got = components.connected_components(simhash.fingerprint_links(nodes, limit=limit), "a", "b").collect()
    found = {r.node: r.component_id for r in got}
    want = {i: c for i, _, c in _components(fps)}
    assert {i: found.get(i, i) for i in range(len(fps))} == want


def test_more_blocks_for_more_fingerprints(spark):
    assert [simhash.blocks_for(n) for n in (0, 10**6, 2**28, 2**32, 2**37)] == [6, 6, 6, 8, 10]
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    fps = sorted(fps | {f ^ sum(1 << b for b in rng.sample(range(64), 3)) for f in fps})
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    found = {r.node: r.component_id for r in components.connected_components(simhash.fingerprint_links(nodes, 8), "a", "b").collect()}
    assert {i: found.get(i, i) for i in range(len(fps))} == {i: c for i, _, c in _components(fps)}


def _components(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, f, root(i)) for i, f in enumerate(fps)]


def test_keep_one(spark, docs, rows):
    out = simhash.keep_one(_clash(docs))
    assert out.columns == _clash(docs).columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    want = {d for d, _, c in _simhash_brute([r[:2] for r in rows]) if d == c and d is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


# --- 10 toxicity ---


def test_toxicity(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "be", "ti", "on", "st"]) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(1200):
        bad = rng.random() < 0.2
        w = [word() for _ in range(40)]
        for _ in range(4 * bad):
            w[rng.randrange(40)] = rng.choice(["IDIOT!", "clown", "lowei" + word()])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(5000, None), (5001, ""), (None, "you clown"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(_clash(docs), spark.createDataFrame(labels + [(None, 1), (4, None)], "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth) > 0.97 * sum(r.doc_id in truth for r in held)
    kept = toxicity.reject_toxic(_clash(docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == _clash(docs).columns and kept.count() < len(rows)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [(r.score, r.predicted) for r in toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()] == [(0.5, 0)]


# --- empty tables ---


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sizes = none.select("doc_id", "source", F.lit(0).alias("size"))
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for out in (
        mixing.mix(sizes), mixing.mix_documents(none), suffix_dedup.digests(none), *warc.archive(pages), embed_dedup.near_duplicates(vectors), bpe.digests(none, path, public_tokenizers.PATTERN),
        pii.pseudonymise(none), quality.quality(none, labels), license_scan.scan(none.select(F.col("doc_id").alias("id"), F.lit("p").alias("path"), "text")),
        simhash.near_duplicates(none), simhash.keep_one(none), toxicity.toxicity(none, labels),
    ):
        assert out.count() == 0
