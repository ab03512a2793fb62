"""The incremental knowledge base: one changed file is one file chunked, and the rows equal a full build."""

from __future__ import annotations

import uuid

from finspark.operators.chunking import chunk_documents
from finspark.operators.kb_increment import ChunkStore
from finspark.operators.kb_index import dictionary, term_counts
from finspark.operators.retrieval import read_markdown_corpus
from finspark.session import ensure_checkpoint_dir

SCHEMA = "source_file string, text string"


def _store(spark):
    return ChunkStore(spark, f"{ensure_checkpoint_dir(spark)}/kb-{uuid.uuid4().hex}")


def _text(i, more=""):
    return f"# Title {i}\n\n" + "\n\n".join(f"## Part {j}\n\nWords of file {i} and part {j}, and some more of them to fill a chunk.{more}" for j in range(3))


def _rows(df):
    return sorted(map(tuple, df.select("chunk_id", "text", "section", "start_line", "end_line").collect()), key=str)


def _equal_to_full(store, corpus):
    full = chunk_documents(corpus)
    assert _rows(store.chunks()) == _rows(full)
    want = dictionary(term_counts(full, ["source_file", "chunk_index"]), full.count())
    got = lambda df: sorted((r.term, r.df, round(r.idf, 9)) for r in df.collect())
    assert got(store.terms()) == got(want)


def test_one_of_a_hundred_files_is_chunked_again(spark, tmp_path):
    folder = tmp_path / "docs"
    (folder / "sub").mkdir(parents=True)
    paths = [folder / ("sub" if i % 3 else ".") / f"f{i}.md" for i in range(100)]
    for i, path in enumerate(paths):
        path.write_text(_text(i))
    (folder / "note.txt").write_text("# not markdown")
    read = lambda: read_markdown_corpus(spark, str(folder))
    store = _store(spark)
    assert store.update(read()) == 100
    paths[41].write_text(_text(41, " Changed."))
    assert store.update(read()) == 1
    assert spark.read.parquet(f"{store.root}/v=1/chunks").select("source_file").distinct().count() == 1
    _equal_to_full(store, read())
    assert store.update(read()) == 0 and store.versions() == 2
    paths[7].unlink()
    (folder / "new.md").write_text(_text(500))
    assert store.update(read()) == 1
    _equal_to_full(store, read())
    store.compact()
    assert [r.since for r in store.files().select("since").distinct().collect()] == [3]
    _equal_to_full(store, read())


def test_an_unfinished_version_did_not_happen(spark):
    store, corpus = _store(spark), spark.createDataFrame([("a.md", _text(1)), ("b.md", _text(2))], SCHEMA)
    store.update(corpus)
    before = _rows(store.chunks())
    later = spark.createDataFrame([("a.md", _text(3)), ("b.md", _text(2))], SCHEMA)
    whole, store._write = store._write, lambda df, n, name: (_ for _ in ()).throw(OSError()) if name == "files" else whole(df, n, name)
    try:
        store.update(later)
    except OSError:
        pass
    store._write = whole
    assert store.versions() == 1 and _rows(store.chunks()) == before
    assert store.update(later) == 1
    assert _rows(store.chunks()) == _rows(chunk_documents(later))


def test_nulls_repeated_paths_and_empty_corpora(spark):
    store = _store(spark)
    assert store.chunks().collect() == [] and store.versions() == 0
    corpus = spark.createDataFrame([("a.md", None), (None, _text(1)), ("b.md", _text(2)), ("b.md", _text(3)), ("c.md", "")], SCHEMA)
    assert store.update(corpus) == 3
    assert _rows(store.chunks()) == _rows(chunk_documents(corpus.where("source_file = 'b.md'")))
    fewer = spark.createDataFrame([("a.md", None), ("b.md", _text(2)), ("c.md", "")], SCHEMA)
    assert store.update(fewer) == 1
    assert _rows(store.chunks()) == _rows(chunk_documents(fewer.where("source_file = 'b.md'")))
    assert store.update(spark.createDataFrame([], SCHEMA)) == 0 and store.chunks().collect() == [] and store.versions() == 3


def test_terms_are_counted_without_a_shuffle(spark, monkeypatch):
    import finspark.operators.kb_increment as increment
    plans, whole = [], increment.term_counts
    def count(chunks, keys):
        df = whole(chunks, keys)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    monkeypatch.setattr(increment, "term_counts", count)
    store = _store(spark)
    corpus = spark.createDataFrame([(f"f{i}.md", _text(i)) for i in range(9)] + [("f1.md", _text(1)), ("f2.md", _text(30))], SCHEMA)
    assert store.update(corpus) == 9
    assert len(plans) == 1 and "Exchange" not in plans[0]
    _equal_to_full(store, corpus)
