"""What Python workers hold: one operator a task, and nothing of the operators before."""

from episcope.llm import common, ngram_join, packing, secrets


def test_masking_runs_one_python_operator_a_task(make_docs):
    docs = make_docs([(1, "password = abcdef123"), (2, "nothing here"), (3, None)])
    masked = secrets.mask(secrets.scan(docs))
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {1: "[SECRET]", 2: "nothing here", 3: None}


def test_masking_scans_once(spark, make_docs):
    seen = spark.sparkContext.accumulator(0)
    docs = make_docs([(i, "token: abcdef%d" % i if i % 2 else "plain words") for i in range(20)])

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = secrets.mask(secrets.scan(docs.mapInArrow(count, docs.schema)))
    assert out.filter("text = '[SECRET]'").count() == 10 and out.count() == 20
    assert seen.value == 20


def test_tasks_drop_what_other_operators_kept(tokenizer):
    common.encoder(tokenizer)
    ngram_join.shingle_set("some words of a text", 3)
    assert common._ENCODERS and ngram_join._WORDS
    assert list(common.lean(iter, keeps=common.ENCODERS)([1, 2])) == [1, 2]
    assert common._ENCODERS and not ngram_join._WORDS
    assert list(common.lean(iter)([])) == []
    assert not common._ENCODERS


def test_all_tasks_of_the_pipelines_operators_are_lean(make_docs, tokenizer, monkeypatch):
    wrapped = []
    for module in (packing, secrets):
        monkeypatch.setattr(module, "lean", lambda run, **kw: wrapped.append(kw) or common.lean(run, **kw))
    docs = make_docs([(1, "secret: abcdefgh"), (2, "words")])
    assert packing.pack_documents(docs, tokenizer).count() == 2
    assert secrets.scan(docs, model=secrets.train(docs)).count() == 2
    assert wrapped == [{"keeps": common.ENCODERS}, {}, {}]
