"""Near copies with edits in one place, against the exact similarity of their shingles."""

import random

from varloom.llm import simhash


def shingles(text, size=5):
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def test_links_are_the_pairs_of_similarity_four_fifths(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: [vocabulary[int(3000 * rng.random() ** 3)] for _ in range(n)]
    rows, alike = [], {}
    for i in range(900):
        w = draw(rng.randint(60, 400))
        n = len(w)
        part = int(n * rng.choice((0.05, 0.1, 0.15, 0.2, 0.24, 0.3)))
        at = rng.randrange(n - part)
        other = [w + draw(part), w[: n - part], w[:at] + draw(part) + w[at + part :]][i % 3]
        a, b = " ".join(w), " ".join(other)
        rows += [(2 * i, a), (2 * i + 1, b)]
        x, y = shingles(a), shingles(b)
        alike[i] = len(x & y) / len(x | y) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    joined = {i: got[2 * i] == got[2 * i + 1] for i in alike}
    assert all(got[k] in (k, k - k % 2) for k in got)
    assert 300 < sum(alike.values()) < 800
    assert sum(joined[i] for i in alike if alike[i]) >= 0.99 * sum(alike.values())
    assert not [i for i in alike if joined[i] and not alike[i]]


def test_a_crowd_of_near_copies_is_one_group(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(i, " ".join(base + [f"x{i}y{j}" for j in range(25)])) for i in range(500)] + [(1000, " ".join(base[:200]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    assert got == {i: 0 for i in range(500)} | {1000: 1000}


def test_pairs_of_a_crowd_that_are_no_links_are_not_listed(spark, monkeypatch):
    listed = []
    confirmed = simhash.Texts.confirmed

    def counted(self, pairs):
        pairs = simhash.settled(pairs)
        listed.append(pairs.count())
        return confirmed(self, pairs)

    monkeypatch.setattr(simhash.Texts, "confirmed", counted)
    rng = random.Random(3)
    rows = []
    for at in range(0, 300, 50):  # crowds of texts that are 0.6 to 0.75 similar, with one link in each
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for i in range(at, at + 49):
            text = base.copy()
            for k in rng.sample(range(300), 9):
                text[k] = f"x{i}y{k}"
            rows.append((i, " ".join(text)))
        rows.append((at + 49, rows[-1][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert {(at + 48, at + 49) for at in range(0, 300, 50)} <= set(links) and len(links) < 60
    root = {i: i for i in sets}
    for i, j in links:
        least, most = sorted((root[i], root[j]))
        root = {k: least if r == most else r for k, r in root.items()}
    assert got == root
    # a pair for each text in a round of leaders, then links alone
    assert len(listed) == simhash.LEADER_ROUNDS + 1 and max(listed[:-1]) <= len(rows)
    assert listed[-1] <= len(links)
