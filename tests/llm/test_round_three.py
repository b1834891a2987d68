"""Manifest, ranked search and private data against brute force on small, awkward rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import exact_dedup, language, merkle, mixing, neighbours, private_data, queries, ranked_search

WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta"]
AWKWARD = [None, "", " \n\t", "one", "One\nline\n", "x" * 5000, "a,b;c--d", "é" * 300, "é1\x00b"]


def stored(spark, folder, rows, schema):
    path = folder()
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


# --- manifest --------------------------------------------------------------

DOC = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string"


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    fields = (r[0], r[3], r[2], r[4], text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_tree(nodes):
    """The root, and per node the (left, right) siblings of itself and its ancestors."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for i in range(len(run)):
                for o in owners[at + i]:
                    paths[o].append(("".join(run[:i]), "".join(run[i + 1:])))
            above.append((h("".join(run)), sum(owners[at:at + 3], [])))
        nodes, owners = [a[0] for a in above], [a[1] for a in above]
    return nodes[0], paths


def plain_manifest(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
        trees[s] = (members, *plain_tree([plain_leaf(r, r[1]) for r in members]))
    root, tops = plain_tree([trees[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = plain_leaf(r, text)
            for left, right in path + top:
                folded = h(left + folded + right)
            proof = h("".join(a + b for a, b in path + top))
            out.append((r[0], plain_leaf(r, r[1]), subroot, root, proof, folded, folded == root))
    return out


def manifest_rows(seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(150):
        text = r.choice(AWKWARD) if i % 4 == 0 else "\n".join(r.choice(WORDS) for _ in range(r.randint(1, 9)))
        source = "hot" if i % 3 == 0 else r.choice([None, "", "a", "é", "z", "src%d" % r.randint(0, 30)])
        rows.append((i, text, r.choice(["en", None]), source, r.choice([None, 7]), "t", "p"))
    # One id with two texts, one row twice, and two rows without an id.
    return rows + [(3, "other", None, "hot", 1, "t", "p"), rows[6], (None, "a\nb", None, None, None, "t", "p"), (None, None, None, None, None, None, None)]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(spark, folder, height):
    rows = manifest_rows()
    found = merkle.prove(merkle.manifest(stored(spark, folder, rows, DOC), height)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_manifest(rows), key=repr)
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("rows", [
    [], [(5, "only\n", "en", "s", 1, "t", "p")], [(i, "t%d" % i, "en", "s%d" % i, 1, "t", "p") for i in range(4)]])
def test_manifest_of_few_rows(spark, folder, rows):
    found = merkle.prove(merkle.manifest(stored(spark, folder, rows, DOC))).collect()
    assert sorted(map(tuple, found)) == sorted(plain_manifest(rows) if rows else [])


def test_manifest_of_a_long_text(spark, folder):
    rows = [(i, "line of a long text\n" * 150_000, "en", "s", 1, "t", "p") for i in range(3)]
    found = merkle.prove(merkle.manifest(stored(spark, folder, rows, DOC))).collect()
    assert sorted(map(tuple, found)) == sorted(plain_manifest(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_climbing_a_block_gives_the_tree(n):
    nodes = [h(str(i)) for i in range(n)]
    root, paths = plain_tree(nodes)
    layers = merkle.climb(nodes, merkle.levels_of(n, 7))
    assert layers[-1] == [root]
    assert [list(zip(*p)) if p[0] else [] for p in merkle._paths(layers)] == paths


# --- ranked search ---------------------------------------------------------

def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n, length = len(counted), sum(t for _, _, t in counted)
    df = Counter(term for _, c, _ in counted for term in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c, total in counted:
            m = 100 - 50 + 50 * total * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(plain_terms(text)) if t in c)
            if score > 0:
                scores.append((-score, -math.inf if doc_id is None else doc_id, doc_id))
        out += [(item_id, i, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return out


def search_rows(seed=5):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + WORDS
    texts = AWKWARD + [" ".join(r.choices(vocabulary, k=r.randint(1, 60))) for _ in range(300)]
    texts += [texts[20]] * 40 + ["w1 w2"] * 30
    docs = list(enumerate(texts)) + [(11, "w1 w2"), (11, "w1 w2"), (None, "w3 w3"), (None, "w4 alpha")]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 12)))) for i in range(12)]
    return docs, items + [(50, None), (51, ""), (52, "unheard of"), (53, "w1 W1,w2"), (53, "w9"), (None, "w5 one")]


@pytest.mark.parametrize("limits", [{}, {"per_shard": 500, "per_block": 3, "whole": 1}, {"per_shard": 100_000, "whole": 8}])
def test_ranked_search(spark, folder, limits):
    docs, items = search_rows()
    found = ranked_search.rank_documents(
        stored(spark, folder, [(*d, 1, "x") for d in docs], "doc_id long, text string, row long, term string"),
        stored(spark, folder, [(*i, "x") for i in items], "item_id long, text string, block string"), 7, **limits).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_search(docs, items, 7), key=repr)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "--")], [(1, "a")])])
def test_ranked_search_without_hits(spark, folder, docs, items):
    found = ranked_search.rank_documents(
        stored(spark, folder, docs, "doc_id long, text string"), stored(spark, folder, items, "item_id long, text string"), 5)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_ranked_search_counts_long_texts_whole(spark, folder):
    docs = [(1, "alpha beta, " * 200_000 + "omega"), (2, "omega psi"), (3, "psi")]
    items = [(1, "omega"), (2, "beta psi")]
    found = ranked_search.rank_documents(
        stored(spark, folder, docs, "doc_id long, text string"), stored(spark, folder, items, "item_id long, text string"), 5)
    assert sorted(map(tuple, found.collect())) == sorted(plain_search(docs, items, 5))


def test_sparse_table_answers_every_range():
    values = np.array(random.Random(1).choices(range(9), k=37), dtype=np.int64)
    table = ranked_search.sparse_table(values, len(values))
    for a, b in itertools.combinations(range(len(values) + 1), 2):
        j = int(b - a).bit_length() - 1
        left, right = table[j, a], table[j, b - (1 << j)]
        assert a <= left < b and a <= right < b and max(values[left], values[right]) == values[a:b].max()


def test_search_leaves_intervals_out():
    """Where one language fills half of the shard, its intervals fall with their bound."""
    r = random.Random(2)
    doc, term, tf = [], [], []
    for d in range(2000):
        for t in r.sample(range(0, 40) if d % 2 else range(40, 80), 10):
            doc.append(d), term.append(t), tf.append(r.randint(1, 5))
    norm = np.full(2000, 100, dtype=np.int64)
    lists, at_place = ranked_search.make_lists(*map(np.array, (doc, term, tf)), norm)
    search = ranked_search.Search(lists, at_place, np.arange(5), np.full(5, 100), 3, whole=16)
    scored = []
    keep = search.score_whole
    search.score_whole = lambda interval: (scored.append(interval.high - interval.low), keep(interval))
    best = search.run()
    scores = Counter()
    for d, t, n in zip(doc, term, tf):
        if t < 5:
            scores[d] += 100 * (1_000_000_000 * n // (1000 * n + 2000))
    assert sorted(best, key=lambda x: (-x[0], x[1])) == [(s, d) for d, s in sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]]
    assert sum(scored) < 1100


# --- private data ----------------------------------------------------------

def plain_patterns(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in re.sub("[^0-9]", "", m.group())]
        checked = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and checked % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def named(spans):
    return [(private_data.KINDS[k], a, b) for a, k, b in spans]


@pytest.mark.parametrize("seed", range(4))
def test_patterns_equal_the_plain_ones(seed):
    r = random.Random(seed)
    parts = ["@", ".", "-", "+", " ", "(", ")", "1", "23", "255", "256", "0001", "a", "b.c", "x@y.de", "4111111111111111",
             "4111-1111 1111 1111", "+1 (743) 555-3824", "10.0.0.1", "\n", "é", "٣", "_", "%"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert [(a, k - 1, b) for a, k, b in private_data.pattern_spans(text)] == plain_patterns(text), text


def test_patterns_are_linear_in_long_words():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * n, "@" * n, "a@" * n, "+1" * n, "+1" + " " * n, "1 " * n, "a." * n + "@b", "." * n + "1"):
        private_data._read_text(text)


def brute_marginals(model, g):
    n = len(g.given)
    own = model.share + model.cells[g.cells].sum(axis=1)
    for i, label in enumerate(g.given):
        if label:
            own[i] = private_data.NEVER
            own[i, label] = 0
    chances = np.zeros((n, private_data.LABELS))
    for labels in itertools.product(range(private_data.LABELS), repeat=n):
        weight = sum(own[i, l] for i, l in enumerate(labels))
        weight += sum(model.links[k, labels[a], labels[b]] for a, b, k in zip(g.one, g.other, g.kind))
        for i, l in enumerate(labels):
            chances[i, l] += math.exp(weight)
    return chances / chances.sum(axis=1, keepdims=True)


def a_model(seed):
    r = np.random.default_rng(seed)
    cells, links = r.normal(0, 1, (private_data.CELLS, private_data.LABELS)), r.normal(0, 0.7, (2, private_data.LABELS, private_data.LABELS))
    links[1] = links[1] + links[1].T
    return private_data.Model(np.log(np.full(private_data.LABELS, 1 / private_data.LABELS)), cells, links)


def a_graph(given, links, seed=0):
    cells = np.random.default_rng(seed).integers(0, private_data.CELLS, (len(given), private_data.FEATURES))
    one, other, kind = (np.array([x[i] for x in links], dtype=np.int64) for i in range(3))
    return private_data.Graph(np.array(given), cells, one, other, kind, np.zeros(len(given), dtype=np.int64))


@pytest.mark.parametrize("seed", range(5))
def test_messages_are_exact_on_trees(seed):
    # A chain 0-1-2, and skip links from 0 to 3 and to 4; and a text of one candidate.
    g = a_graph([0, 0, 4, 0, 0, 0], [(0, 1, 0), (1, 2, 0), (0, 3, 1), (0, 4, 1)], seed)
    model = a_model(seed)
    assert np.allclose(private_data.marginals(model, g), brute_marginals(model, g), atol=1e-6)


@pytest.mark.parametrize("seed", range(5))
def test_messages_are_near_on_loops(seed):
    g = a_graph([0, 0, 0, 0, 2], [(0, 1, 0), (1, 2, 0), (2, 3, 0), (0, 3, 1), (0, 4, 1), (3, 4, 0)], seed)
    model = a_model(seed)
    found, exact = private_data.marginals(model, g), brute_marginals(model, g)
    assert np.abs(found - exact).max() < 0.25


def corpus():
    r = random.Random(7)
    words = ["call", "the", "of", "mail", "to", "and", "it", "house"]
    rows, kinds = [], [
        lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", lambda: f"{r.choice(words)}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com",
        lambda: ".".join(str(r.randint(10, 250)) for _ in range(4)), lambda: r.choice(["4111111111111111", "5500005555555559"]),
        lambda: f"{r.randint(1, 99)}", lambda: f"{r.randint(1900, 2100)}."]
    for i in range(400):
        parts = [r.choice(words) for _ in range(30)]
        for _ in range(r.randint(0, 4)):
            said = r.choice(kinds)()
            for _ in range(r.randint(1, 3)):
                parts.insert(r.randint(0, len(parts)), said)
        rows.append((i, " ".join(parts)))
    return rows


def test_private_data(spark, folder):
    rows = corpus()
    mention = "call +1 (743) 555-3824 to the house and then, of it, the 555-3824 number, also 5553824; 42 of it."
    twice = "mail of.11@mail2.example.com to and it +1 (215) 555-1212 the"
    joined = "it of 4111111111111111 5500005555555559 of the"
    clean = "the house of 1999 and 12 of it"
    planted = [(1000, mention), (1001, joined), (1002, clean), (1003, None), (1004, ""), (1005, twice), (1005, twice), (None, "a@b.de")]
    everything = rows + planted
    found = private_data.find_private(stored(
        spark, folder, [(*row, "x", 1) for row in everything], "doc_id long, text string, spans string, id long")).collect()
    assert len(found) == len(everything)
    texts = defaultdict(list)
    for doc_id, text in everything:
        texts[doc_id].append(text or "")
    for row in found:
        base, spans = [tuple(s) for s in row.base], [tuple(s) for s in row.spans]
        assert base == named(plain_patterns(texts[row.doc_id][0]))
        assert set(base) <= set(spans)
        order = [(s[1], private_data.KINDS.index(s[0])) for s in spans]
        assert order == sorted(order)
    said = {row.doc_id: [(s.kind, texts[row.doc_id][0][s.start:s.end]) for s in row.spans] for row in found}
    assert ("phone", "555-3824") in said[1000]
    assert "42" not in [text for _, text in said[1000]]
    assert said[1002] == said[1003] == said[1004] == []
    assert said[1005] == [("email", "of.11@mail2.example.com"), ("phone", "+1 (215) 555-1212")]
    assert ("card", "4111111111111111") in said[1001]
    # Rows without a pattern's match are nearly all left alone.
    plain = [row for row in found if not row.base]
    assert sum(bool(row.spans) for row in plain) <= 0.01 * len(plain) + 1


def test_private_data_of_no_rows(spark, folder):
    found = private_data.find_private(stored(spark, folder, [], "doc_id long, text string"))
    assert found.columns == ["doc_id", "base", "spans"] and found.collect() == []


def test_private_data_query_equals_the_plain_patterns(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in queries.op13_private_data(spark, sf_dir).collect():
        base = named(plain_patterns(texts[row.doc_id]))
        told = [":".join(map(str, s)) for s in base]
        assert row.base_sha256 == h(",".join(told))
        assert [row[f"n_{kind}"] for kind in private_data.KINDS] == [sum(s[0] == kind for s in base) for kind in private_data.KINDS]
        assert set(told) <= set(row.spans.split(",")) | {""}


# --- earlier operators -----------------------------------------------------

def test_neighbours_behind_many_rows_of_one_id(spark, folder):
    rows = [(0, [1.0, 0.0])] * 10 + [(7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0]), (101, [0.5, 0.8])]
    found = neighbours.nearest(stored(spark, folder, rows, "vec_id long, embedding array<double>"), 4).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 7), (2, 8), (3, 9), (4, 101)]


def test_a_batch_added_again_under_its_name_keeps_its_rows(spark, folder):
    docs = stored(spark, folder, [(1, "a"), (2, "A"), (3, "b"), (None, None), (4, "")], "doc_id long, text string")
    index = exact_dedup.new_index(spark)
    first, again = (sorted((r["doc_id"] or 0) for r in index.add(docs, batch="one").where("kept").collect()) for _ in range(2))
    assert first == again == [2, 3, 4]
    assert index.add(docs, batch="two").where("kept").collect() == []


def test_repeated_rows_are_mixed_as_often_as_they_have_copies(spark, folder):
    rows = [(1, "a b c", "s")] * 3 + [(2, "a b", "s"), (3, "x " * 9, "t"), (None, None, "t"), (None, None, "t")]
    docs = stored(spark, folder, rows, "doc_id long, text string, source string")
    made = Counter()
    for r in mixing.mix(docs, (3, 1), 2).collect():
        made[(r["doc_id"], r["source"])] += r["copies"]
    got = Counter((r["doc_id"], r["source"]) for r in mixing.mixed_rows(docs, (3, 1), 2).collect())
    assert got == Counter({k: v for k, v in made.items() if v})


def test_small_and_whole_rates_are_dealt_evenly(spark, folder, monkeypatch):
    """Neither a source of which little is taken nor one at its cap meets in a few bins, and the order is kept."""
    rows = [(i, "a b", "big") for i in range(4000)] + [(10_000 + i, "a", "full") for i in range(1500)]
    rows += [(20_000 + i, None, "none") for i in range(1500)]
    docs = stored(spark, folder, rows, "doc_id long, text string, source string")
    tables, written = {}, mixing.staged
    monkeypatch.setattr(mixing, "staged", lambda df, label, *a: tables.update({label: written(df, label, *a)}) or tables[label])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, (1, 2000, 1), 3).collect()}
    sizes = tables["mix-rated"].groupBy("source", "bin").count().collect()
    assert Counter(r["source"] for r in sizes) == dict.fromkeys(("big", "full", "none"), mixing.BINS)
    whole = {"big": 4000, "full": 1500, "none": 1500}
    assert all(r["count"] <= 2 + 2 * whole[r["source"]] / mixing.BINS for r in sizes)
    assert {taken[i] for i, _, s in rows if s == "full"} == {3} and {taken[i] for i, _, s in rows if s == "none"} == {0}
    rated = sorted((r["priority"], r["doc_id"], r["whole"], r["target"]) for r in tables["mix-rated"].where("source = 'big'").collect())
    left = round(rated[0][3]) - sum(2 * int(w) for _, _, w, _ in rated)
    for _, doc, base, _ in rated:
        more = max(0, min(2, left))
        left -= more
        assert taken[doc] == 2 * base + more


# --- language evidence -----------------------------------------------------


def plain_buckets(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    codes = [low[i] | low[i + 1] << 8 | low[i + 2] << 16 for i in range(len(low) - 2)]
    return [(c * 0x9E3779B1 & 0xFFFFFFFF) >> 19 for c in codes]


def plain_softmax(scores):
    powers = [math.exp(s) for s in scores]
    return [p / sum(powers) for p in powers]


def plain_languages(labelled, rows):
    """Per row the posterior of every class, the last being none."""
    names = sorted({lab for _, lab in labelled if lab not in (None, "", "und")})
    counts = {lab: Counter(b for t, own in labelled if own == lab for b in plain_buckets(t)) for lab in names}
    size = language.BUCKETS
    likely = [[0.95 * counts[x][b] / max(1, counts[x].total()) + 0.05 / size for b in range(size)] for x in names]
    likely.append([0.1 * sum(c) / len(names) + 0.9 / size for c in zip(*likely)])
    n, told = len(likely), []
    for _, text, *evidence in rows:
        sums = [sum(math.log(c[b]) for b in plain_buckets(text)) for c in likely]
        weighed = [0.3 * (s - max(sums)) for s in sums]
        told.append((weighed, plain_softmax(weighed), [e or "" for e in evidence]))
    sums_of = lambda key: {k: [sum(p[i] for _, p, e in told if key(e) == k) for i in range(n)] for k in {key(e) for _, _, e in told}}
    rows_of = lambda key: Counter(key(e) for _, _, e in told)
    total = sums_of(lambda e: 0)[0]
    share = [(t + 1) / (len(rows) + n) for t in total]
    keys = [lambda e: e[0], lambda e: e[1], lambda e: (e[3], e[2]), lambda e: e[3]]
    (declared, suffix, host, domain), amounts = [sums_of(k) for k in keys], [rows_of(k) for k in keys]
    out = []
    for weighed, _, e in told:
        d, s, h, z = (k(e) for k in keys)
        scores = []
        for i in range(n):
            above = (domain[z][i] + 20 * share[i]) / (amounts[3][z] + 20)
            prior = (host[h][i] + 20 * above) / (amounts[2][h] + 20)
            speaks = [(sums[v][i] + 20 * amount[v] / len(rows)) / (total[i] + 20)
                      for sums, v, amount in ((declared, d, amounts[0]), (suffix, s, amounts[1]))]
            scores.append(math.log(prior) + math.log(speaks[0]) + math.log(speaks[1]) + weighed[i])
        out.append(plain_softmax(scores))
    return names, out


def test_language_evidence_is_fused_as_by_hand(spark, folder):
    r = random.Random(3)
    say = {"aa": ["mora", "tiel", "vask"], "bb": ["ouin", "lere", "chau"], "cc": ["mora", "lere", "zwt"]}
    talk = lambda x, k: " ".join(r.choice(say[x]) for _ in range(k))
    labelled = [(talk(x, 30), x) for x in say for _ in range(4)]
    labelled += [("mora", "und"), ("lere", ""), ("tiel", None), (None, "aa"), ("same words", "aa"), ("same words", "bb")]
    rows = [(talk(x, r.randint(1, 6)), r.choice([x, "aa", None]), r.choice([x, "com", ""]), f"{r.choice('pq')}.{x}.org", f"{x}.org")
            for x in say for _ in range(15)]
    rows += [(t, None, "com", "p.aa.org", "aa.org") for t in (None, "", "ab", "same words", "MORA Tiel", "日本語の文", "0x7f " * 900)]
    rows += [rows[0], rows[0], ("mora lere", None, None, None, None)]
    rows = [(i, *row) for i, row in enumerate(rows)]
    docs = stored(spark, folder, labelled, "text string, lang string")
    pages = stored(spark, folder, rows, "row long, text string, declared string, suffix string, host string, domain string")
    names, want = plain_languages(labelled, rows)
    model = language.train(docs)
    assert list(model.languages) == names
    found = {f["row"]: f for f in language.identify(pages, model).collect()}
    assert len(found) == len(rows)
    for (i, text, *_), posterior in zip(rows, want):
        assert found[i]["confidence"] == pytest.approx(max(posterior), abs=1e-9)
        first, second = sorted(posterior, reverse=True)[:2]
        if first - second > 1e-9 and abs(first - 0.5) > 1e-9:
            best = [*names, "und"][posterior.index(first)]
            rejected = not plain_buckets(text) or first < 0.5 or best == "und"
            assert (found[i]["lang"], found[i]["rejected"]) == ("und" if rejected else best, rejected)
    none = spark.createDataFrame([], pages.schema)
    assert language.identify(none, model).count() == 0
