"""A passage that holds no whole chunk is found by its pairs of lines."""

import random

from terrascape.llm import line_dedup, queries_groups


def test_short_passages_are_found_whole(spark, tmp_path):
    rng = random.Random(3)
    line = lambda: "".join(rng.choice("abcdefgh ") for _ in range(36)).replace(" ", "x")
    docs = []
    for _ in range(30):
        passage = [line() for _ in range(6)]
        docs += [(len(docs) + k, "\n".join([*[line() for _ in range(rng.randrange(1, 5))], *passage, line()])) for k in (0, 1)]
    df = spark.createDataFrame([*docs, (100, "one line"), (101, None), (102, "")], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_groups.op8_line_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got if r.n_removed == 6} == {i for i, _ in docs if i % 2}
    assert line_dedup.WHOLE != line_dedup.ORACLE
