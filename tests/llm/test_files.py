"""Token files: exact round trips, ids equal to the library's on whole texts, the pipeline against its stages' rules."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from orewright.llm.queries import QUERIES, SQL
from orewright.llm.token_files import Block, ChunkEncoder, EliasFano, block_bytes, read_token_files, write_token_files
from orewright.session import work_folder

from .conftest import odd_texts
from .test_pairs import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("values", [[0], [5], [0, 0, 0], [10**12], list(np.cumsum([7, 0, 0, 9] * 400)), list(np.cumsum(np.arange(3000) % 977))])
def test_elias_fano_round_trip(values):
    code, end = EliasFano.from_bytes(b"xx" + EliasFano.of(np.array(values)).to_bytes(), 2)
    assert code.all().tolist() == values and [code.select(i) for i in range(len(values))] == values
    bits = 8 * (len(code.low) + code.high.nbytes + code.samples.nbytes)
    assert bits <= (3.2 + np.log2(max(values) / len(values) + 1)) * len(values) + 256
    with pytest.raises(IndexError):
        code.select(len(values))


@pytest.mark.parametrize("top", [1000, 100_000])
def test_block_round_trip(top):
    draw = np.random.default_rng(0)
    lengths = draw.integers(1, 50, 700)
    ids, names = draw.integers(0, top, lengths.sum()), np.sort(draw.integers(-500, 10**9, 700))
    block = Block(block_bytes(names, lengths, ids))
    begin = np.concatenate(([0], np.cumsum(lengths)))
    assert (block.names.all() + block.first == names).all()
    for i in (0, 1, 255, 256, 699):
        assert block.document(i).tolist() == ids[begin[i] : begin[i + 1]].tolist()


def test_chunks_encode_like_whole_texts():
    draw = random.Random(1)
    alphabet = list("abzABZ'stredvml.,!? \n\t\x0b\x1c019éÉßÿ×÷ª½µ́  ΣσİıǅñÑ<|>日本‍_-")
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += [*odd_texts(), "don't we'll it's", "<|endoftext|> a<|startoftext|>b", "'S 'RE ''s", "é ́e"]
    encoder = ChunkEncoder(PATH)
    ids, n = encoder.texts(pa.array(texts), 1)
    ends = np.cumsum(n)
    whole = [e.ids + [1] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == whole


def test_files_hold_every_document_in_order(odd_docs, ready):
    path = work_folder(ready, "tokens")
    write_token_files(odd_docs, path, PATH)
    got = sorted(map(tuple, read_token_files(ready, path).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect() if r.doc_id is not None), key=lambda r: r[0])
    encoder, at, want = ChunkEncoder(PATH), 0, []
    for i, t in rows:
        ids = encoder.tokenizer.encode(t, add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello  World's\tend\n", None, "", "naïve ÉTÉ 12,345 <|endoftext|> x"]
    encoder = ChunkEncoder(path)
    ids, lengths = encoder.texts(pa.array(texts), 7)
    want = [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == [len(w) for w in want]
    assert not encoder.by_chunk and ChunkEncoder(PATH).by_chunk


def test_files_of_nothing(ready):
    path = work_folder(ready, "tokens")
    write_token_files(ready.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert read_token_files(ready, path).count() == 0


def test_pipeline_stages_take_effect(odd_docs, ready, tmp_path, sample):
    """On odd rows: each stage keeps the columns and drops only what its operator rejects."""
    for name in ("labels", "benchmark"):
        ready.read.parquet(f"{sample}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs, counts = odd_docs, [odd_docs.count()]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(ready, docs, str(tmp_path))
        assert docs.columns == odd_docs.columns, name
        counts.append(docs.count())
    texts = odd_texts()
    assert counts[1] == counts[2] < counts[0]
    near = corpus_pipeline.STAGES[1][1](ready, odd_docs, str(tmp_path))
    kept = [r.doc_id for r in near.collect()]
    first = [i for i, (_, component) in brute(dict(enumerate(texts))).items() if i == component]
    assert sorted(kept, key=repr) == sorted([*first, None], key=repr)


def test_pipeline_takes_one_row_an_id(ready, tmp_path, sample):
    """Rows without an id are refused at the door, with those beside the longest text of an id; both are counted."""
    for name in ("labels", "benchmark"):
        ready.read.parquet(f"{sample}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    item = ready.read.parquet(f"{sample}/benchmark.parquet").first()["text"]
    rows = [(1, "short"), (1, "a longer text"), (1, None), (2, "b"), (2, "a"), (2, "b"), (None, item), (None, None), (3, None)]
    docs = ready.createDataFrame([(i, t, "s", 5) for i, t in rows], "doc_id long, text string, source string, n int")
    assert sorted(map(tuple, corpus_pipeline.admitted(docs).collect()), key=repr) == sorted([(1, "a longer text", "s", 5), (2, "b", "s", 5), (3, None, "s", 5)], key=repr)
    assert {r["reason"]: r["rows"] for r in corpus_pipeline.refused(docs).collect()} == {"no id": 2, "id repeated": 4}
    assert {r["rows"] for r in corpus_pipeline.refused(docs.limit(0)).collect()} == {0}
    kept = corpus_pipeline.STAGES[0][1](ready, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, 2, 3}
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(ready, str(tmp_path)).collect()} <= {1, 2, 3}


def test_pipeline_runs_on_the_sample(ready, sample):
    rows = corpus_pipeline.run(ready, sample).collect()
    in_order = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order[:-1]]).tolist()
    assert [r.doc_id for r in in_order] == sorted(r.doc_id for r in rows)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.QUERIES["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_check_sql(ready, sample, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sample}/{t}.parquet'")
    df = QUERIES[name](ready, sample)
    cur = con.execute(SQL[name])
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in cur.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_new_chunks_are_encoded_together():
    """The encoder asks its tokenizer once for many new chunks and agrees with it on each, also when its stores start anew."""
    draw = random.Random(9)
    chunks = ["".join(draw.choice("abcdEFß'.,0çÿÀ") for _ in range(draw.randint(1, 9))) for _ in range(3000)] + ["it's", "日本", "a<|b", "Ōe"]
    texts = [None, "", *(" ".join(draw.choices(chunks, k=40)) for _ in range(300))]
    encoder, asked = ChunkEncoder(PATH), 0

    class Counted:
        def encode(self, *args, _own=encoder.words, **kwargs):
            nonlocal asked
            asked += 1
            return _own.encode(*args, **kwargs)

    encoder.words = Counted()
    for _ in range(2):
        ids, lengths = encoder.texts(pa.array(texts), 1)
        want = [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        encoder._renew()
    assert 1 <= asked <= 4
