import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docmill.llm import idcoder, tokenfiles
from docmill.llm import queries as q

from .helpers import odd_docs

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(texts):
    from tokenizers import Tokenizer

    return [np.array([*e.ids, 1], "<u4") for e in Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("vocab, shape", [(1, (2, 60)), (3, (4, 1000)), (49408, (3, 4096)), (1 << 16, (2, 300)), (1 << 20, (3, 500)), (1 << 26, (1, 70)), (50, (1, 1))])
def test_coder_gives_ids_back(vocab, shape):
    r = np.random.default_rng(vocab)
    ids = r.integers(0, vocab, shape).astype(np.uint32)
    ids[0] = np.where(r.random(shape[1]) < 0.8, ids[0, 0], ids[0])  # a run, so that predictions hold
    codes = idcoder.encode(ids, vocab)
    back = idcoder.decode(codes, [shape[1]] * shape[0], vocab)
    assert all(np.array_equal(a, b) for a, b in zip(ids, back))
    # Blocks depend on nothing but themselves.
    assert idcoder.encode(ids[-1:], vocab) == codes[-1:]
    assert np.array_equal(idcoder.decode(codes[-1:], [shape[1]], vocab)[0], ids[-1])


def test_each_order_of_context_saves_room():
    r = random.Random(5)
    pairs = {(a, b): r.randrange(50) for a in range(50) for b in range(50)}
    x = [1, 2]
    while len(x) < 4096:
        x.append(pairs[x[-2], x[-1]] if r.random() < 0.95 else r.randrange(50))
    shuffled = r.sample(x, len(x))
    size = lambda ids: len(idcoder.encode(np.array([ids], np.uint32), 50)[0])
    assert size(x) < 0.7 * size(shuffled)  # orders 1 and 2
    assert size([min(i, 9) for i in shuffled]) < 0.7 * size(shuffled)  # order 0
    assert size([7] * 4096) < 200


def stream_of(docs, vocab=300):
    out = io.BytesIO()
    out.close = lambda: None
    w = tokenfiles.FileWriter(out, vocab)
    for i, ids in docs:
        w.add(i, np.array(ids, np.uint32))
    w.close()
    return out.getvalue()


def opened(raw):
    return pa.BufferReader(raw)


def test_file_holds_documents_across_blocks(monkeypatch):
    monkeypatch.setattr(idcoder, "LANES", 2)
    r = random.Random(1)
    docs = [(None, [3]), (-5, []), (1, [r.randrange(300) for _ in range(5000)]), (2, []), (3, [r.randrange(300) for _ in range(23000)]), (3, [7]), (9, [])]
    raw = stream_of(docs)
    got = list(tokenfiles.documents(opened(raw), "x"))
    assert [(i, ids.tolist()) for i, _, ids in got] == docs
    starts = np.cumsum([0, *[len(d) for _, d in docs[:-1]]]).tolist()
    assert [s for _, s, _ in got] == starts
    some = list(tokenfiles.documents(opened(raw), "x", lambda ids, null: (ids == 3) & (null == 0)))
    assert [(i, s, len(d)) for i, s, d in some] == [(3, 5001, 23000), (3, 28001, 1)]
    assert list(tokenfiles.documents(opened(stream_of([])), "x")) == []


def test_damage_is_refused():
    raw = stream_of([(1, list(range(200)) * 30)])
    index = tokenfiles.FileIndex(opened(raw), "x")
    at = int(index.offsets[1]) + 40
    for bad in (raw[:at] + bytes([raw[at] ^ 4]) + raw[at + 1 :], raw[:-1], raw[:20], raw[:-40] + bytes([raw[-40] ^ 1]) + raw[-39:]):
        with pytest.raises(ValueError):
            list(tokenfiles.documents(opened(bad), "x"))
    # The undamaged block can still be read by itself.
    assert len(list(tokenfiles.documents(opened(raw), "x"))) == 1


def test_ids_must_be_below_the_vocabulary():
    with pytest.raises(ValueError, match="below 300"):
        stream_of([(1, [300])])


def test_query_equals_whole_texts(spark):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()))
    got = {r.doc_id: r for r in q.op11_token_output(spark, SF).collect()}
    assert len(got) == len(rows)
    start = 0
    for (i, _), ids in zip(rows, whole_ids(t for _, t in rows)):
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


ODD = ["it's DON'T we'LL ''s", "á é x y　z", "İstanbul ΣΑΣ\nΣ", "日本語 テキスト，。", "<|endoftext|> x<|endoftext|>y < |endoftext|>", "12 3.4e5 ١٢", " ́lone mark \ń", "a\tb\rc\x0bd\x85e", "x" * 5000, "\U0001f600‍!! ok"]


def test_words_give_the_ids_of_whole_texts(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    want = dict(enumerate(x.tobytes() for x in whole_ids(ODD)))
    for drops in (True, False):
        assert {r.doc_id: bytes(r.ids) for r in tokenfiles.tokenized(docs, WORDS, 1, drops).collect()} == want


def test_odd_rows_appends_and_filters(spark, tmp_path, monkeypatch):
    docs, path = odd_docs(spark), f"{tmp_path}/ids"
    tokenfiles.write_documents(docs, path, WORDS, drops_space=True)
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip([(r.doc_id is not None, r.doc_id or 0) for r in rows], [x.tobytes() for x in whole_ids(r.text for r in rows)]))
    got = tokenfiles.read_files(spark, path).orderBy("start", "n_tokens").collect()
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [i for i, _ in want]
    assert sorted(bytes(r.ids) for r in got) == sorted(b for _, b in want)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (3, 4, 5, 8)] == [1, 1, 1, 1]

    total = sum(r.n_tokens for r in got)
    tokenfiles.write_documents(docs.where("doc_id = 7"), path, WORDS, drops_space=True)
    again = tokenfiles.read_files(spark, path).where("doc_id = 7").orderBy("start").collect()
    assert len(again) == 2 and again[1].start == total and again[0].ids == again[1].ids
    lengths = tokenfiles.read_files(spark, path, ids=False).where("doc_id in (6, 7) and doc_id > 6").collect()
    assert [(r.doc_id, r.n_tokens, r.ids) for r in lengths] == [(7, again[0].n_tokens, None)] * 2
    assert tokenfiles.read_files(spark, path).where("doc_id is null").count() == 1


def test_empty_table_and_files_without_a_commit(spark, tmp_path):
    path = f"{tmp_path}/ids"
    tokenfiles.write_documents(odd_docs(spark).limit(0), path, WORDS)
    (tmp_path / "ids" / "part-lost.ids").write_bytes(stream_of([(1, [1])]))
    assert tokenfiles.read_files(spark, path).count() == 0
    with pytest.raises(Exception, match="appended"):
        tokenfiles.tokenized(odd_docs(spark), WORDS).write.format("token_ids").option("vocab", 50000).mode("overwrite").save(path)


def test_many_words_are_forgotten_and_looked_up_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfiles._Words, "MOST", 3)
    own = tokenfiles._Words(Tokenizer.from_file(WORDS))
    texts = ["one two three four five", "one six " + "y" * 100, "", "seven one two"]
    assert [own.encode(t) for t in texts] == [x[:-1].tobytes() for x in whole_ids(texts)]
    assert "y" * 100 not in own.known
    assert own.encode("a<|endoftext|>b c<|startoftext|> <|endoftext|>") == whole_ids(["a<|endoftext|>b c<|startoftext|> <|endoftext|>"])[0][:-1].tobytes()
