"""License scans against a plain version of the method, and planted wordings."""

import random
import re
from collections import Counter

import duckdb
import pytest

from skyledger.llm import licenses, oracle


def words_in(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def plain(rows):
    files = [(i, words_in(text)) for i, text in rows]
    df = Counter(w for _, words in files for w in set(words))
    out = []
    for i, words in files:
        places, score = [], 0.0
        for t in licenses.TEMPLATES:
            if not set(t.key_words) <= set(words):
                continue
            rare = sorted(set(t.words) & set(words), key=lambda w: (df[w], w))[:licenses.RARE]
            votes = Counter(s for r in rare for s in {p - o for p, w in enumerate(words) if w == r for o, x in enumerate(t.words) if x == r})
            for s in (s for s, n in votes.items() if n >= 2):
                near = lambda at, key: any(
                    tuple(words[q:q + len(key)]) == key for q in range(max(s + at - t.slack, 0), s + at + t.slack + 1))
                if all(near(at, key) for at, key in t.keys):
                    places.append((t, s))
                    same = sum(0 <= s + k < len(words) and words[s + k] == w for k, w in enumerate(t.words))
                    score = max(score, same / len(t.words))
        base = [(s, t.label) for t, s in places if t.base]
        out.append((i, len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    ",".join(sorted({x for _, x in base})), ",".join(sorted({t.label for t, _ in places})), score))
    return out


def planted():
    say = random.Random(5)
    filler = "the of and this is software license permission any copy version free public under terms notice to use or".split() + [
        f"w{i}" for i in range(60)]
    noise = lambda n: " ".join(say.choice(filler) for _ in range(n))
    rows, want = [], {}
    for i, t in enumerate(licenses.WORDINGS):
        whole = list(t.words)
        first = t.keys[0][0] + len(t.keys[0][1])
        edited = whole[:first] + ["some", "inserted", "words"] + whole[first:]
        head = whole[t.keys[0][0]:]
        for j, wording in enumerate((whole, edited, head)):
            rows.append((100 * i + j, f"{noise(40)}.\n# {', '.join(wording).upper()}; {noise(30)}"))
            want[100 * i + j] = t.label
        key = list(t.keys[-1][1])
        rows.append((100 * i + 50, f"{noise(40)} {' '.join(reversed(key))} {noise(20)}"))
        want[100 * i + 50] = None
    return rows, want


AWKWARD = [(9001, None), (9002, ""), (9003, " ;,\n"), (9004, "MIT License, MIT license"), (9004, "MIT License, MIT license"),
           (9005, "mit " * 3 + "license"), (9006, "é Apache\tLicense 2"), (9007, "CC-BY 4.0"), (9008, "by cc license mit"),
           (None, "gnu general public license version 3"), (9009, "all rights reserved " + "the of " * 60_000 + "Apache License")]

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def values(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_wordings_without_a_name_are_found_and_clean_files_left_alone(spark):
    rows, want = planted()
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = {r["doc_id"]: set(r["labels"]) for r in found.collect()}
    for i, label in want.items():
        assert (label in labels[i]) if label else not labels[i], (i, label, labels[i])


def test_scan_is_the_plain_method_and_the_sql(spark):
    rows = planted()[0] + AWKWARD
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, words string, held long").repartition(5)
    got = values(licenses.digest_columns(licenses.scan_licenses(docs)))
    assert got == sorted(plain(rows), key=repr)
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    told = base.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.licenses_sql()})").fetchall()
    assert sorted(told, key=repr) == got


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_key_must_stand_in_its_wording():
    with pytest.raises(StopIteration):
        licenses.template("x", "some words of it", "other words")
