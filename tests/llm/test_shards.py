from __future__ import annotations

import numpy as np
import pytest

from shopfunnel.llm.shards import from_segment, read_shards, to_segment, write_shards
from shopfunnel.llm.tokens import vocabulary_path
from shopfunnel.session import work_path


def expected(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    out, at = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, at, len(ids), ids))
        at += len(ids)
    return out


def test_exact_round_trip(spark):
    rows = [(k * 7 % 101, f"text {k} with words {k * 13}\n" * (k % 9)) for k in range(100)]
    rows += [(5, "again"), (5, "again"), (200, None), (None, "no id"), (300, ""), (301, "very long " * 60_000), (-4, "less é漢")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, start int").repartition(5)
    path = work_path(spark, "shards")
    write_shards(docs, path)
    got = read_shards(spark.read.parquet(path)).collect()
    found = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in sorted(got, key=lambda r: r.start)]
    assert found == expected(rows)


def test_segment_is_checked():
    with pytest.raises(ValueError):
        from_segment(b"none of it" * 9)
    lengths, ids = from_segment(to_segment([1, 0, 3], np.array([7, 2**32 - 1, 0, 9], "<u4")))
    assert lengths.tolist() == [1, 0, 3] and ids.tolist() == [7, 2**32 - 1, 0, 9]


def test_empty_table(spark):
    path = work_path(spark, "shards")
    write_shards(spark.createDataFrame([], "doc_id long, text string"), path)
    assert read_shards(spark.read.parquet(path)).count() == 0
