import __spark_entry__ as entry
import cases
import corpus_pipeline
import public_tokenizers
import test_decontaminate
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import lang_id

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage on the rows that the one before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name == "packing":
            break
        assert docs.columns == columns
        ids = {r.doc_id for r in after}
        assert len(ids) == len(after)
        if name == "language_id":
            model = lang_id.fit(spark.createDataFrame(before, docs.schema).filter(~lang_id.held_out("doc_id")), "text", "lang", F.col("doc_id"))
            want = {r.doc_id for r in before if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= 0.5}
        elif name == "exact_dedup":
            want = set({(r.text or "").translate(cases.LOWER): r.doc_id for r in sorted(before, key=lambda r: r.doc_id)}.values())
        elif name == "jaccard_join":
            rows = sorted(before, key=lambda r: r.doc_id)
            want = {}
            for r, g in zip(rows, cases.similar([r.text for r in rows]), strict=True):
                want.setdefault(g, r.doc_id)
            want = set(want.values())
        else:
            want = {r.doc_id for r in before} - {doc for doc, _ in test_decontaminate.brute([(r.doc_id, r.text) for r in before], bench)}
        assert ids == want, name
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
    found = {}
    for r in after:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == want[r.doc_id]
    assert found == want
    # the stages run one after another give the same pieces' documents as run()
    run = entry.queries()["pipeline"](spark, FOLDER).groupBy("doc_id").sum("length").collect()
    assert dict(map(tuple, run)) == want


def test_stages_take_empty_tables_and_odd_columns(spark):
    for name, stage in corpus_pipeline.STAGES:
        for table in (cases.empty(spark), cases.docs(spark, cases.AWKWARD, cases.AWKWARD_IDS)):
            out = stage(spark, table, FOLDER)
            if name != "packing":
                assert out.schema == table.schema
            assert out.count() <= 40 * table.count()
