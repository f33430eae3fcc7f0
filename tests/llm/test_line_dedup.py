"""Repeated lines against a plain version."""

import hashlib
from collections import defaultdict

import pytest

from candlewick.llm import line_dedup
from tests.llm.helpers import ODD, ascii_lower, frame, key

SPACE = " \t\n\x0b\x0c\r"


def plain(rows, least=40, documents=5):
    holders = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        for k in {ascii_lower(x.strip(SPACE)) for x in (text or "").split("\n")}:
            if len(k) >= least:
                holders[k].append((i, doc))
    keeper = {k: max((d for _, d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= documents}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if (k := ascii_lower(x.strip(SPACE))) not in keeper or (doc == keeper[k])]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=key)


COMMON = "This line stands in many of the documents, 40+"
WIDE = "é" * 39 + "x"


def rows():
    out = [(i, f"own line of document number {i}, which is long enough\n {COMMON.upper() if i % 2 else COMMON}\t\nend") for i in range(10, 30)]
    out += [(i, f"{WIDE}\n{'ü' * 39}\n{WIDE}") for i in range(40, 45)] + [(i, "four documents have this line and so it stays here") for i in range(50, 54)]
    return out + ODD + [(None, COMMON), (29, COMMON)]


@pytest.mark.parametrize("bits", [9, 12, 25])
def test_against_plain(spark, bits):
    got = line_dedup.dedup_lines(frame(spark, rows()), bits=bits).select("doc_id", "n_lines", "n_dropped", "text")
    assert sorted(map(tuple, got.collect()), key=key) == plain(rows())


def test_digests_and_columns(spark, tmp_path):
    frame(spark, rows()).write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain(rows())]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    whole = line_dedup.dedup_lines(frame(spark, rows()))
    assert whole.columns == ["doc_id", "text", "n_tokens", "score", "fp", "spans", "key", "part", "n_lines", "n_dropped"]
    assert {r.key for r in whole.collect()} == {"own"}


def test_only_null_ids(spark):
    same = [(None, COMMON)] * 6
    got = line_dedup.dedup_lines(frame(spark, same)).collect()
    assert [(r.n_dropped, r.text) for r in got] == [(0, COMMON)] * 6


def test_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_rows_of_one_id_and_the_sql(spark, tmp_path):
    """Each row is a document of its own, also under a repeated or missing id, in the SQL too."""
    import duckdb

    own = [(None, f"line number {i} of its own, long enough to be looked at\n{COMMON}") for i in range(30)]
    data = rows() + own + [(29, f"{COMMON}\n{COMMON}"), (29, "x")]
    frame(spark, data).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(line_dedup.OP3_SQL).fetchall()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r.n_dropped for r in got if r.doc_id is None) >= 30
