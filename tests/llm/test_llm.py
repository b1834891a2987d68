"""Each operator against a brute-force version on small, awkward rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import bpe, chat, exact_dedup, language, licenses, lm_scoring, mixing, near_dedup, neighbours, queries, suffix_dedup

WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
AWKWARD = [None, "", " \t\n", "one", "One", "a b c d", "x" * 5000, "MIT License MIT license", "CC-BY 4.0", "é" * 300]


@pytest.fixture(scope="session")
def docs_of(spark, tmp_path_factory):
    """Rows (doc_id, text, lang, source) as a stored table with an extra column of a clashing name."""

    def make(rows):
        df = spark.createDataFrame(
            [(*r, *[None] * (4 - len(r)), "x") for r in rows],
            "doc_id long, text string, lang string, source string, row string")
        path = str(tmp_path_factory.mktemp("docs") / "table")
        df.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


def random_texts(n, seed=1):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(2)
    own = random_texts(25)
    near = [" ".join(w if r.random() > 0.01 else "edit%d" % r.randint(0, 99) for w in t.split()) for t in own[:8]]
    long = " ".join(r.choice(WORDS) + str(r.randint(0, 500)) for _ in range(200))
    passages = ["%d %s %d" % (i, long[200:700], i) for i in range(4)] + [long, long.replace("alpha", "ALPHA", 1)]
    return [*AWKWARD, *own, *near, *own[:4], *passages]


@pytest.fixture(scope="module")
def rows(texts):
    # One id twice with one text, one id twice with two texts, and a missing id.
    return [*enumerate(texts), (3, "one"), (3, "another text of five words"), (None, "alone here")]


@pytest.fixture(scope="module")
def docs(docs_of, rows):
    return docs_of(rows)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in (text or ""))


def test_empty_tables_give_no_rows(docs_of):
    none = docs_of([])
    path = queries.vocabulary_path()
    assert bpe.round_trip(none, path).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert exact_dedup.new_index(none.sparkSession).add(none).count() == 0
    assert near_dedup.near_duplicates(none)[0].count() == 0
    assert licenses.scan_licenses(none).count() == 0
    assert lm_scoring.score(none).count() == 0
    assert language.accepted(none).count() == 0


def test_bpe_is_the_library(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    path = queries.vocabulary_path()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    got = [(a, b, bytes(c), d) for a, b, c, d in collected(bpe.round_trip(docs, path))]
    apart = [(a, b, bytes(c), d) for a, b, c, d in collected(bpe.decode(bpe.encode(docs, path), path))]
    assert sorted(got, key=repr) == sorted(apart, key=repr) == sorted(want, key=repr)


def test_bpe_special_strings_and_long_words():
    from tokenizers import Tokenizer

    with open(queries.vocabulary_path(), "rb") as file:
        raw = file.read()
    own, library = bpe.WordBpe(raw), Tokenizer.from_str(raw.decode())
    for text in ["a<|endoftext|>b", "<|startoftext|><|endoftext|> x", "ΣΑΣ İ", "ab" * 400, "'s it's WE'LL", "\x1c\x85 é"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_repeats(docs, rows):
    seen = defaultdict(list)
    raw = [(t or "").encode() for _, t in rows]
    for k, b in enumerate(raw):
        for p in range(len(b) - 199):
            seen[b[p:p + 200]].append((k, p))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        for k, p in places if len(places) > 1 else ():
            gone[k][p:p + 200] = b"\1" * 200
    want = [(i, len(b), sum(g), sum(1 for p in range(len(g)) if g[p] and not (p and g[p - 1])),
             hashlib.sha256(bytes(x for x, y in zip(b, g) if not y)).hexdigest()) for (i, _), b, g in zip(rows, raw, gone)]
    got = suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256))
    assert sum(w[2] for w in want) > 2000
    assert collected(got) == sorted(want, key=repr)


def test_near_duplicates(docs, rows):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    want = [(i, len(sets[k]), least.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]
    found, links = near_dedup.near_duplicates(docs)
    assert collected(found.select("doc_id", "n_shingles", "component_id")) == sorted(want, key=repr)
    assert links.count() > 0
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({root(k) for k in range(len(rows))})


def test_blocks_find_every_component():
    import pyarrow as pa

    pack = lambda *x: np.array(sorted(x), dtype=np.uint64).tobytes()
    names = [b"a", b"b", b"c"]
    block = pa.table({"class": names, "root": [b"a", b"b", b"b"], "set": [pack(1, 2, 3, 4), pack(9, 10), pack(1, 2, 3, 5)]})
    asked = pa.table({"class": [b"z"], "root": [b"z"], "set": [pack(1, 2, 3, 4, 5)]})
    found = near_dedup._linked_in_block(asked, block).to_pylist()
    assert {f["b"] for f in found} == {b"a", b"c"}


def test_exact_copies_and_the_index(spark, docs, rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    index = exact_dedup.new_index(spark)
    found = index.add(docs)
    number = lambda ids: max((i for i in ids if i is not None), default=None)
    want = [(i, number(groups[lower(t)]), len(groups[lower(t)])) for i, t in rows]
    assert collected(found.select("doc_id", "keep_id", "group_size")) == sorted(want, key=repr)
    assert found.where("kept").count() == len(groups)
    again = index.add(docs)
    assert again.where("kept").count() == 0 and index.rows().count() == len(groups)
    kept = exact_dedup.keep_first_copies(docs, exact_dedup.new_index(spark))
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_mix_reaches_its_targets(docs_of):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), "en", r.choice(["a", "b", "b", "b", None])) for i in range(300)]
    rows += [(1000, None, "en", "empty"), (1000, None, "en", "empty")]
    docs = docs_of(rows)
    found = mixing.mix(docs).collect()
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    taken, target, size = Counter(), {}, {}
    for f in found:
        taken[f["source"]] += f["taken"]
        target[f["source"]], size[f["source"]] = f["target"], f["source_size"]
        assert 0 <= f["taken"] <= 3 * f["size"]
    assert len(found) == len(rows) and abs(sum(target.values()) - total) < 1
    for source in target:
        assert target[source] <= 3 * size[source] + 1e-6 and abs(taken[source] - target[source]) <= 1
    assert collected(mixing.mix(docs).select("doc_id", "taken")) == sorted(((f["doc_id"], f["taken"]) for f in found), key=repr)
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_mix_with_base_rates(spark):
    rows = spark.createDataFrame([(i, "w " * 10, "s" if i % 2 else "t", 0.5 + i % 5) for i in range(200)], "doc_id long, text string, source string, q double")
    found = mixing.mix(rows, (1, 3), base="q").groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(abs(f["n"] - f["t"]) <= 10 for f in found)


def test_licenses(docs, rows):
    phrases = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    want = []
    for i, text in rows:
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if x]
        at = [(p, label) for label, phrase in phrases.items() for p in range(len(w)) if w[p:p + len(phrase.split())] == phrase.split()]
        want.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    got = licenses.digest_columns(licenses.scan_licenses(docs))
    assert collected(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want, key=repr)
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language(spark, docs_of):
    say = {"de": "der und nicht ", "en": "the and of ", "es": "los que para ", "fr": "les dans une "}
    rows = [(k * 100 + i, say[l] * (1 + i % 7), l, "s%d" % (i % 3)) for k, l in enumerate(say) for i in range(40)]
    docs = docs_of([*rows, (9001, None, "en", "s1"), (9002, "", None, None), (9003, "the and of the and of", "fr", "s0")])
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} | {9003}
    model = language.train(docs)
    pages = spark.createDataFrame([
        (1, "http://a.example.com/fr/1", "<html lang='fr'><p>les dans une les dans"), (2, None, None),
        (3, "https://x.de/", "<script>the the</script><p>der und nicht der und")], "page_id long, url string, html string")
    found = {r["row"]: r for r in language.identify(language.page_rows(pages), model).collect()}
    assert (found[1]["lang"], found[3]["lang"], found[3]["suffix"]) == ("fr", "de", "de")
    assert found[2]["rejected"] and found[2]["lang"] == "und"


@pytest.mark.parametrize("lookup", [200_000, 5])
def test_scores(monkeypatch, docs, rows, lookup):
    monkeypatch.setattr(lm_scoring, "LOOKUP", lookup)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    want = [(i, held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n,
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6)) for i, t in rows]
    found = lm_scoring.score(docs).collect()
    assert sorted(((f[0], f[1], f[2], f[3], f[4], round(f["base_score"], 6)) for f in found), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(f["score"]) and f["score"] < 0 for f in found)


def test_chats_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", None, "", "<|end|> <\\|turn|> <\\\\|x", "é😀  \n", "[\\INST] <<SYS>> <s>", "plain"]
    rows = [(c, t, ["user", "assistant", None, "<|text|>"][(c + t) % 4], texts[(c * 3 + t) % 7]) for c in range(9) for t in range(8)]
    rows += [(0, 1, "assistant", "twice"), (None, None, "assistant", "no id")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())
    want = {}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        want[c] = (turns, "".join(t for role, t in turns if role == "assistant"))
    back = chat.read_back(chat.format_chats(frame, queries.vocabulary_path("byte_bpe_50k.json"))).collect()
    assert {b["conv_id"]: ([tuple(t) for t in b["turns"]], b["learned"]) for b in back} == want
    assert all(chat.unescape(chat.escape(t or "")) == (t or "") for t in texts)


def test_neighbours_are_exact(spark):
    r = np.random.default_rng(1)
    vectors = r.normal(size=(900, 8)).astype("float32")
    vectors[100:160] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [0.0] * 8), (1051, [float("nan")] * 8), (1052, [1.0, None] + [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    want = []
    for q in range(0, 900, 50):
        scores = unit @ unit[q]
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-round(scores[i], 12), i))[:5]
        want += [(q, k + 1, i) for k, i in enumerate(best)]
    found = neighbours.nearest(frame)
    assert sorted((f["query_id"], f["rank"], f["vec_id"]) for f in found.collect()) == want


def test_pipeline_keeps_clean_documents(spark, docs_of):
    say = random_texts(30, 7)
    rows = [(i, t + " und the que les %d %d %d %d %d" % (i, i, i, i, i), "en", "src%d" % (i % 3)) for i, t in enumerate(say)]
    docs = docs_of([*rows, (100, "".join(c.upper() if c < "\x80" else c for c in rows[3][1]), "en", "src1"), (101, None, "en", "src1")]).select("doc_id", "text", "lang", "source")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = corpus_pipeline.staged(stage(spark, kept, ""), name)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(30) if i != 3} | {100}
    mixed = corpus_pipeline.staged(corpus_pipeline.mix(spark, kept, ""), "mixing")
    assert mixed.columns == docs.columns
    done = corpus_pipeline.tokenize(spark, mixed, "")
    assert done.count() == mixed.count() and done.where("n_tokens = 0").count() == 0


def test_stages_keep_the_rows_they_decided_on(spark, docs_of):
    say = {"de": "der und nicht ", "en": "the and of ", "es": "los que para ", "fr": "les dans une "}
    good = [(k * 20 + i, "".join(say[l] + "%d%d " % (k, i) * 3 for _ in range(4)), l, "st"[i % 2]) for k, l in enumerate(say) for i in range(20)]
    rows = good + [(1000 + i, None, "en", "s") for i in range(40)] + [(2000 + r[0], *r[1:]) for r in good]
    random.Random(3).shuffle(rows)
    docs = docs_of(rows)
    bare = {r[0] for r in rows if r[1] is None}
    stages = [
        (language.accepted, {r[0] for r in rows} - bare),
        (lambda d: exact_dedup.keep_first_copies(d, exact_dedup.new_index(spark)), {2000 + r[0] for r in good} | {max(bare)}),
        (near_dedup.one_of_each, {r[0] for r in good} | bare),
        (lambda d: mixing.mixed_rows(d, (3, 1), 2), [c[0] for c in mixing.mix(docs, (3, 1), 2).select("doc_id", "copies").collect() for _ in range(c[1])])]
    for stage, want in stages:
        kept = stage(docs)
        # Files are dealt to tasks in another way than when the stage decided.
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        try:
            got = [r["doc_id"] for r in kept.select("doc_id").collect()]
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        assert sorted(got) == sorted(want)


def test_hot_leads_are_not_one_bucket(monkeypatch, docs_of):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 8)
    r = random.Random(5)
    own = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    passage, tails, heads = own(500), [own(60) for _ in range(7)], [own(90) for _ in range(7)]
    rows = [(i, own(300 + i) + r.choice(heads) + passage + r.choice(tails) + own(300)) for i in range(60)]
    rows += [(100 + i, own(250) + passage[:230] + own(250)) for i in range(20)] + [(7, rows[7][1]), (None, rows[8][1])]
    docs, dealt = docs_of(rows), []
    whole = type(docs).repartitionByRange
    monkeypatch.setattr(type(docs), "repartitionByRange", lambda self, *a: dealt.append((self, whole(self, *a))) or dealt[-1][1])
    test_repeats(docs, rows)
    [(contexts, buckets)] = dealt
    hot = max(f["count"] for f in contexts.groupBy("lead").count().collect())
    most = max(f["count"] for f in buckets.groupBy(F.spark_partition_id()).count().collect())
    assert most < 4 * 8 < hot


def test_language_rejects_what_is_in_none(docs_of):
    say = {"de": "der und nicht eine ist auch werden", "en": "the and of which there have been", "es": "los que para como una pero muy",
           "fr": "les dans une avec pour nous sont", "nl": "het een niet zijn maar wordt deze"}
    r = random.Random(6)
    text = lambda l, n: " ".join(r.choice(say[l].split()) for _ in range(n))
    clean = [(k * 100 + i, text(l, 8 + i), l if i % 3 else None, "s%d" % (i % 3)) for k, l in enumerate(say) for i in range(40)]
    other = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw", "Все люди рождаются свободными и равными",
             "人人生而自由,在尊严和权利上一律平等", "0x9f3a 7c41 $$ %% 8be2 ffa0 1c9d 77e3 {}[]<> 00ab 93cd ==++ 4412", "---- **** //// ;;;; ????"]
    junk = [(1000 + i, t, None, "s%d" % (i % 3)) for i, t in enumerate(other)]
    docs = docs_of(clean + junk)
    assert {f["doc_id"] for f in language.accepted(docs).collect()} == {c[0] for c in clean}
    found = language.identify(docs, language.train(docs), row="doc_id", declared=None, suffix=None, host="source", domain=None)
    want = {k * 100 + i: l for k, l in enumerate(say) for i in range(40)} | {j[0]: "und" for j in junk}
    assert {f["row"]: f["lang"] for f in found.collect()} == want


def test_repeat_across_a_piece_of_a_long_text(docs_of):
    r = random.Random(11)
    own = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage, border = own(460), suffix_dedup.PIECE
    long, short = own(border - 230) + passage + own(5000), own(300) + passage + own(300)
    found = {d["doc_id"]: d for d in suffix_dedup.remove_repeats(docs_of([(1, long), (2, short), (3, own(900))])).collect()}
    at = {i: [(s["start"], s["stop"]) for s in found[i]["spans"]] for i in found}
    for i, text, start in ((1, long, border - 230), (2, short, 300)):
        lo = next(k for k in range(20) if long[border - 231 - k] != short[299 - k])
        hi = next(k for k in range(20) if long[border + 230 + k] != short[760 + k])
        assert at[i] == [(start - lo, start + 460 + hi)]
        assert found[i]["kept"] == (text[:start - lo] + text[start + 460 + hi:]).encode()
    assert at[3] == []
