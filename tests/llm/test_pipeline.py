import hashlib
from collections import Counter

import sentencepiece

import corpus_pipeline
from millrace.llm.mixing import rates
from millrace.llm.sentencepieces import default_model
from millrace.llm.toxicity import score

from . import test_jaccard, test_mixing, test_quality

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "near_duplicates", "mixing", "sentencepiece"]
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, held[-1], SF)
        out.write.parquet(str(tmp_path / name))
        held.append(spark.read.parquet(str(tmp_path / name)))
    for df in held[1:-1]:
        assert df.columns == docs.columns
    # 1: what the rules keep
    good = [(d, t) for d, t in rows(held[0]) if not test_quality.brute(t)[-1] and test_quality.compressed_well(t)]
    assert Counter(rows(held[1])) == Counter(good)
    # 2: only rows predicted toxic go
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from millrace.llm.toxicity import learn

    predicted = {r["doc_id"] for r in score(held[1], learn(held[1], labels)).where("predicted = 1").collect()}
    assert Counter(rows(held[2])) == Counter(x for x in good if x[0] not in predicted)
    # 3: one row of each class
    before = rows(held[2])
    wanted = [x for x, b in zip(before, test_jaccard.brute(before), strict=True) if b[0] == b[1]]
    assert Counter(rows(held[3])) == Counter(wanted)
    # 4: Poisson counts
    sources = [(r["doc_id"], r["source"]) for r in held[3].collect()]
    rate_of = {r["__source"]: r["rate"] for r in rates(held[3]).collect()}
    counts = test_mixing.brute_counts(sources, rate_of)
    assert Counter(d for d, _ in rows(held[4])) == Counter({d: n for d, n in counts.items() if n})
    # 5: the library's ids
    lib = sentencepiece.SentencePieceProcessor(model_file=default_model())
    ids = {d: lib.encode(t) for d, t in rows(held[4])}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = Counter((d, len(ids[d]), sha(",".join(map(str, ids[d]))), sha(lib.decode(ids[d]))) for d, _ in rows(held[4]))
    assert Counter(map(tuple, held[5].collect())) == wanted
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == wanted
