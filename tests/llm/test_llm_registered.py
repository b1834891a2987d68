"""The registered training-data queries over the smallest whole tables: against SQL in another engine, or the library."""

import glob
import hashlib
import os
import struct

import pytest

from skyledger.llm import queries
from skyledger.llm.registry import all_queries, all_sql

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
DIGITS = 9

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(rows, order):
    return sorted((tuple(round(v, DIGITS) if isinstance(v, float) else v for v in (r[i] for i in order)) for r in rows), key=repr)


def test_every_sql_has_its_query():
    assert set(all_sql()) <= set(all_queries())
    assert {name.split("_")[0] for name in all_queries()} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


@pytest.mark.parametrize("name", all_sql())
def test_query_equals_sql(spark, database, name):
    result = all_queries()[name](spark, SF_DIR)
    cursor = database.execute(all_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert set(columns) == set(result.columns)
    assert plain(result.collect(), range(len(columns))) == plain(
        cursor.fetchall(), [columns.index(column) for column in result.columns])


def test_bpe_query_equals_the_library(spark, database):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    expected = []
    for doc_id, text in database.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((
            doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8")).hexdigest()))
    got = queries.op1_bpe(spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert plain(got.collect(), range(4)) == plain(expected, range(4))
