import json

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docmill.llm import queries as q

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in df.collect()))


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "clicks", "sales"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(q.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = sorted(json.dumps(dict(zip(names, r)), sort_keys=True, default=str) for r in cur.fetchall())
    assert rows(q.queries()[name](spark, SF)) == want


def test_registered():
    assert {n.split("_")[0] for n in q.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(q.queries()) | {"pipeline"} <= set(entry.queries())


def test_chat_query_has_the_probe(spark):
    import hashlib

    out = {r.conv_id: r for r in q.op3_chat_format(spark, SF).collect()}
    text = "</s>[INST] ok [/INST]"
    assert out[-7].n_turns == 2 and out[-7].loss_chars == len(text)
    assert out[-7].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert out[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    src = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        src.setdefault(r.conv_id, []).append(r)
    assert set(out) == set(src) | {-7}
    for i, turns in src.items():
        turns.sort(key=lambda r: r.turn)
        assert out[i].turns_sha256 == hashlib.sha256("".join(f"{r.role}\n{r.text}\n" for r in turns).encode()).hexdigest()
        assert out[i].loss_sha256 == hashlib.sha256("".join(r.text for r in turns if r.role == "assistant").encode()).hexdigest()


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).persist()
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert out.count() == len(after) and set(after) <= set(before)
        if i < 4:
            assert out.columns == docs.columns and all(after[k] == before[k] for k in after)
        if name == "exact_dedup":
            best = {}
            for k, r in before.items():
                best[r.text] = max(k, best.get(r.text, k))
            assert set(after) == set(best.values())
        if name == "near_dedup":
            from .test_minhash import brute

            assert set(after) == {k for k, (_, c) in brute([(k, r.text) for k, r in before.items()], percent=80).items() if c == k}
        if name == "mixing":
            assert out.where("taken <= 0 OR taken > 2 * size").count() == 0
        docs = out


def test_warc_query_with_repeated_pages(spark, tmp_path):
    import hashlib

    bodies = ["<p>" + "a" * 1500, "<p>" + "b" * 1500, "tiny", None, "é" * 600]
    data = [(i, f"http://h/{i}", bodies[i * i % 5]) for i in range(40)]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in q.op2_warc(spark, str(tmp_path)).collect()}
    assert len(got) == 40
    for i, _, html in data:
        body = (html or "").encode()
        top = max(j for j, _, h in data if (h or "") == (html or ""))
        again = len(body) >= 1000 and top != i
        want = (len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None)
        assert tuple(got[i])[1:5] == want
