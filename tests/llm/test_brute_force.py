"""Every operator against a plain version of its contract, on the small tables and on hand-made rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from varloom.llm import chat, licenses, media, mixing, packing, queries, secrets, simhash, tokens, topk, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (900001, None, "src0"),
    (900002, "", None),
    (900003, " \n\t ", "src0"),
    (900003, " \n\t ", "src0"),
    (900004, "token = 'ab<|endoftext|>cd' Token: secret: abcdefgh12 AKIAABCDEFGH1234567 " + "0a" * 20 + " é😀password=ABCDEFGH", "zé"),
    (900005, "x" * 50_000 + " " + "deadbeef" * 9, "src1"),
    (None, "a b c\x1cd e f İΣ it's we'll 123 the MIT License and CC-BY GNU General Public License", "src1"),
    (900007, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nrest", "src2"),
    (900008, "idiot " * 30, "src2"),
    (900009, "GIF89a BM RIFF0000WAVE", "src2"),
]


def table(name):
    return duckdb.sql(f"select * from '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang", "n_chars")
    odd = spark.createDataFrame([(i, t, s, "en", 1) for i, t, s in ODD], base.schema)
    return base.unionByName(odd).selectExpr("*", "'x' as key", "1 as size", "'y' as fp", "'z' as blob_", "0 as target").cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text or "", r.source) for r in docs.select("doc_id", "text", "source").collect()]


def bag(rows):
    return Counter(map(tuple, rows))


def test_token_counts(docs, plain):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, x, _ in plain:
        n = len(t.encode(x, add_special_tokens=False).ids)
        want[(i, len(x.encode()), n, n > 2048)] += 1
    assert bag(tokens.count_tokens(docs).collect()) == want


def plain_fingerprint(text, size=4):
    w = text.encode().lower().split()
    sh = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, tau):
    """fps: list of (id, fp)."""
    a = np.array([f for _, f in fps], dtype=np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= tau):
            root[find(i)] = find(int(j))
    least = {}
    for i, (key, _) in enumerate(fps):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash(docs, plain):
    fps = [(i, plain_fingerprint(x)) for i, x, _ in plain]
    want = bag((i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps, 4)))
    assert bag(simhash.near_duplicates(docs).collect()) == want


@pytest.mark.parametrize("parts", [2, 3, 4, 5])
def test_generalised_pigeonhole_loses_no_link(spark, parts):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base.tolist():
        for _ in range(6):
            x = b
            for bit in rng.integers(0, 64, rng.integers(1, 7)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps |= {0, (1 << 64) - 1} | {sum(1 << k for k in range(n)) for n in range(0, 30)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f, f) for f in signed], "node long, fp long")
    got = {r.node: r.root for r in simhash.linked(nodes, 4, parts=parts).collect()}
    want = plain_components([(f, f & ((1 << 64) - 1)) for f in signed], 4)
    groups = defaultdict(set)
    for f, w in zip(signed, want):
        groups[w].add(f)
    found = defaultdict(set)
    for f in signed:
        found[got.get(f, f)].add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))


def test_crowded_group_keeps_its_components(spark):
    """Hundreds of fingerprints around one, a chain that hangs on it by single links, and a crowd of its own."""
    rng = np.random.default_rng(5)
    base, other = 0x0123456789ABCDEF, 0x7EDCBA9876543210
    fps = {base, other}
    for centre, n in ((base, 500), (other, 200)):
        for _ in range(n):
            x = centre
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    x = base
    for bit in range(20, 60, 4):
        x ^= 0b1111 << bit
        fps.add(x)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f, f) for f in signed], "node long, fp long")
    got = {r.node: r.root for r in simhash.linked(nodes, 4).collect()}
    found = defaultdict(set)
    for f in signed:
        found[got.get(f, f)].add(f)
    want = defaultdict(set)
    for f, w in zip(signed, plain_components([(f, f & ((1 << 64) - 1)) for f in signed], 4)):
        want[w].add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_thresholds_fill_the_budget():
    rng = np.random.default_rng(1)
    costs = [np.vstack([np.zeros(50), np.sort(rng.random((5, 50)), axis=0)]) for _ in range(3)]
    picked = simhash.allocate(costs, 4)
    assert ((picked + 1).sum(axis=1) == 5).all()
    best = np.full(50, np.inf)
    for a in range(6):
        for b in range(6 - a):
            c = 5 - a - b
            best = np.minimum(best, costs[0][a] + costs[1][b] + costs[2][c])
    got = sum(costs[i][picked[:, i] + 1, np.arange(50)] for i in range(3))
    assert np.allclose(got, best)


BASE = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": (2, 8), "access": (0, 16), "hex": (0, 32)}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        group, least = LEAST[kind]
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def plain_secret_rows(rows):
    out = Counter()
    for i, text, *_ in rows:
        spans = plain_spans(text)
        n = Counter(s.split(":")[0] for s in spans)
        out[(i, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    return out


def test_secrets(docs, plain):
    rows = secrets.digest(secrets.scan_paths(docs)).collect()
    assert bag(r[:5] for r in rows) == plain_secret_rows(plain)
    assert sum(r.n_hex for r in rows) > 0 and sum(r.n_assign for r in rows) > 0


def test_ledger_scans_only_unseen_pairs(spark, docs):
    old = secrets.update_ledger(docs.filter("doc_id % 2 = 0"), rules=secrets.BASE).cache()
    new = secrets.update_ledger(docs, old)
    both = new.join(old, ["blob", "rule", "version"])
    assert both.count() == 0
    seen = {r.blob for r in old.collect()}
    assert all(r.rule in {x.kind for x in secrets.ADDED} for r in new.collect() if r.blob in seen)
    whole = bag(map(str, secrets.digest(secrets.scan_paths(docs)).collect()) and [(str(r),) for r in secrets.digest(secrets.scan_paths(docs)).collect()])
    again = bag([(str(r),) for r in secrets.digest(secrets.scan_paths(docs, old)).collect()])
    assert whole == again


def test_redaction(spark):
    text = "a token = 'abcdefgh1' b 0123456789abcdef0123456789abcdef c"
    df = spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r.x for r in secrets.scan_paths(df).select("doc_id", secrets.redacted(secrets.F.col("text"), secrets.F.col("spans")).alias("x")).collect()}
    assert out == {1: "a [SECRET]' b [SECRET] c", 2: "clean", 3: None}


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nx"), (1, 1, "assistant", "a<%b<|c<%|"), (1, 2, "user", None),
        (2, 0, "system", "s"), (2, 1, "assistant", "one"), (2, 2, "assistant", ""), (2, 3, "assistant", "two\n"),
        (3, None, None, "x"), (4, 0, "user", "dup"), (4, 0, "user", "dup"), (None, 5, "ro\nle<|", "t"), (5, 0, "user", "é😀" * 3000),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, example string, parts int")
    got = {r.conv_id: r for r in chat.digest(chat.prefix_examples(chat.with_probe(df))).collect()}
    probe = "<|im_end|><|im_start|>assistant ok"
    groups = defaultdict(list)
    for c, t, r, x in [*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)]:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        told = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.prefix_examples(df).filter("conv_id = 2").orderBy("example").collect()
    assert [e.formatted[e.loss_start : e.loss_stop] for e in examples] == ["one", "", "two\n"]
    assert all(e.formatted.count("<|im_start|>") == n for e, n in zip(examples, (2, 3, 4)))


def plain_topk(rows, k=20):
    rows = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows]
    out = []
    for at, (q, a) in enumerate(rows):
        if q is not None and q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i) for n, (i, b) in enumerate(rows) if n != at)[:k]
            out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(scored)]
    return bag(out)


def test_topk(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = plain_topk(rows)
    assert bag(topk.top_k(df, topk.F.col("id") % 20 == 0).collect()) == want
    assert bag(topk.top_k(df, topk.F.col("id") % 20 == 0, shard_rows=100, block_rows=1).collect()) == want


def test_topk_ties_nulls_and_wide_values(spark):
    inf, nan = float("inf"), float("nan")
    same = [(i, [1.0, -1.0]) for i in range(0, 300)]
    bad = [(1000, None), (1020, [1.0, None]), (1040, [nan, 1.0]), (1060, [inf, 1.0])]
    loose = [(None, [1.0, 1.0]), (None, [3.0, -1.0])]
    df = spark.createDataFrame(same + bad + loose + same[:50], "vec_id long, embedding array<double>")
    got = bag(topk.top_k(df, topk.F.col("id") % 20 == 0, shard_rows=64).collect())
    assert got == plain_topk(same + loose + same[:50])  # rows that repeat an id are rows of their own
    named = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [0.5, 0.0]), (7, [0.25, 0.0]), (0, [2.0, 0.0])]
    extra = spark.createDataFrame(named, df.schema).selectExpr("*", "1 as id", "2 as at", "'x' as vector", "3 as width", "4 as kth")
    assert bag(topk.top_k(extra, topk.F.col("id") % 20 == 0).collect()) == plain_topk(named)
    huge = [(0, [1e12, -3.0]), (1, [1e3, 5.25]), (2, [-1e3, 1.0]), (20, [0.5, 0.0])]
    got = topk.top_k(spark.createDataFrame(huge, df.schema), topk.F.col("id") % 20 == 0).collect()
    assert bag(got) == plain_topk(huge)


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licenses(docs, plain):
    rows = licenses.scan_licenses(docs).collect()
    assert bag(r[:6] for r in rows) == bag((i, *plain_phrases(x)) for i, x, _ in plain)
    tagged = next(r for r in rows if r.doc_id == 900007)
    assert tagged.labels == "apache-2.0,gpl-2.0-only-with-classpath-exception-2.0,mit" and tagged.n_base == 0
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)


def test_licence_expressions():
    def ways(value):
        inner = [{(k,)} if x is None else ways(x) for k, x in value.parts.items()]
        if value.op == "and":
            return {tuple(sorted(set().union(*x))) for x in itertools.product(*inner)}
        return set().union(*inner)

    def of(e):
        value = licenses.terms(e)
        return ways(value) if value else set()

    assert of("MIT or Apache-2.0 and BSD") == {("mit",), ("apache-2.0", "bsd")}
    assert of("(MIT or Apache-2.0) and BSD") == {("bsd", "mit"), ("apache-2.0", "bsd")}
    assert of("GPL-2.0 with X or MIT") == {("gpl-2.0-with-x",), ("mit",)}
    assert of("(MIT") == of("and MIT") == of("MIT and") == of("") == set()


def test_packing(docs, plain):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, lengths = Counter(), []
    for i, x, _ in plain:
        ids = [*t.encode(x, add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], dtype="<u4").tobytes()
            want[(i, n, at, len(part) // 4, zlib.crc32(part))] += 1
            lengths.append(len(part) // 4)
    rows = packing.pack(docs).collect()
    assert bag(r[:5] for r in rows) == want
    fills = defaultdict(list)
    for r in rows:
        fills[r.sequence_id].append((r.offset, r.length))
    for parts in fills.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(4096 - sum(n for _, n in f) for f in fills.values()) == sorted(plain_best_fit(lengths, 4096))


def plain_best_fit(lengths, capacity):
    """Capacity left in each bin of best fit decreasing, one item at a time."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if not fits:
            fits = [[capacity]]
            bins.append(fits[0])
        tightest = min(fits, key=lambda b: b[0])
        tightest[0] -= n
    return [b[0] for b in bins]


@pytest.mark.parametrize("seed", range(6))
def test_bulk_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(8, 80))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 800)))
    if seed % 2:
        lengths = np.minimum(lengths, 1 + rng.integers(0, capacity // 2, len(lengths)))
    plan = packing.best_fit_decreasing(np.bincount(lengths, minlength=capacity + 1), capacity)
    rank = np.zeros(len(lengths), np.int64)
    for n in np.unique(lengths):
        rank[lengths == n] = np.arange((lengths == n).sum())
    bins, offset = packing.place(plan, lengths.astype(np.int64), rank)
    left = Counter()
    for b in np.unique(bins):
        parts = sorted(zip(offset[bins == b], lengths[bins == b]))
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        left[capacity - int(lengths[bins == b].sum())] += 1
        assert lengths[bins == b].sum() <= capacity
    assert plan.bins == len(np.unique(bins))
    assert sorted(left.elements()) == sorted(plain_best_fit(lengths.tolist(), capacity))


def test_media(docs, plain):
    want = Counter()
    for i, x, _ in plain:
        raw = x.encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        want[(i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))] += 1
    rows = media.inspect(media.store(docs)).collect()
    assert bag((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    assert {r.media_type for r in rows} == {"audio/wav"} and all(r.corrected for r in rows)


def test_carving():
    def chunk(kind, data):
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", bytes(13)) + chunk(b"IEND", b"")
    gif = b"GIF89a" + bytes([1, 0, 1, 0, 0, 0, 0]) + b"\x2c" + bytes(8) + b"\x00\x02\x01\x00\x00" + b"\x3b"
    stored = media.wave(b"xxGIF89a no" + png + b"BM RIFF" + gif + bytes(5))
    found = media.sniff(stored)
    assert found[0] == ("audio/wav", 0, len(stored))
    assert [(k, stored[a : a + n]) for k, a, n in found[1:]] == [("image/png", png), ("image/gif", gif)]
    assert media.sniff(stored[:-1]) == found[1:]  # a cut container is no WAVE any more
    assert media.read_payload(media.wave(b"abc"), "audio/wav") == b"abc"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, full, rest = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            full.add(s)
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]


def test_mixing(docs, plain, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    size = {(i, s): len(WORD.findall(x)) for i, x, s in plain}
    sizes = Counter()
    for _, x, s in plain:
        sizes[s] += len(WORD.findall(x))
    target = plain_targets(sizes)
    rows = mixing.mix(docs).collect()
    assert bag((r.doc_id, r.source, r["size"]) for r in rows) == bag((i, s, len(WORD.findall(x))) for i, x, s in plain)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert bag(mixing.mix(docs.repartition(5)).select("doc_id", "taken").collect()) == bag((r.doc_id, r.taken) for r in rows)


def test_pivotal_rounding_keeps_means():
    sizes = np.array([5, 9, 2, 7, 7, 1, 30])
    p = np.array([0.3, 0.5, 0.9, 0.1, 0.7, 0.2, 0.4])
    total = np.zeros(7)
    for seed in range(4000):
        q, held = mixing.pivot(sizes, p, [(i,) for i in range(7)], seed, 0)
        assert abs((q * sizes).sum() - (p * sizes).sum()) < 1e-9
        assert sum(0 < x < 1 for x in q) <= 1
        total += q
    assert np.abs(total / 4000 - p).max() < 0.035


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(toxicity.labelled(docs, labels.filter("doc_id % 3 <> 0")))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(r.doc_id, r.toxic) for r in labels.filter("doc_id % 3 = 0").collect()]
    hit = sum(got[i].rejected for i, t in held if t)
    false = sum(got[i].rejected for i, t in held if not t)
    assert hit >= 0.85 * sum(t for _, t in held) and false <= 0.01 * len(held)
    assert all(0 <= r.severity <= 2 for r in got.values())


def test_toxicity_odd_rows(spark, docs):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (1, None, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, labels).count() == docs.count()
    assert toxicity.toxicity(docs, labels.limit(0)).filter("rejected").count() == 0


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = queries.queries()[name](spark, str(tmp_path)).collect()
    assert len(rows) == (1 if name == "op5_chat_format" else 0)
