"""Every operator and pipeline stage over awkward tables: nulls in any column, empty and very long texts, repeated rows, clashing names, no rows."""

import datetime

import pytest
from pyspark.sql import functions as F

pytest.importorskip("corpus_pipeline")

import corpus_pipeline
from playlog.llm import chat, decontaminate, infill, langid, media, neardup, packing, quality, repair, secrets, sharding, simhash, urlfilter, warc
from playlog.llm.queries import URL_BLOCKED, URL_RULES, tokenizer_path

CLASH = "row key fp spans score predicted lines bad_lines line_good lang_pred digest media group shard slot component_id fingerprint items position ids tokens part before n __row __row_0 label x leaf law id point root least first a b".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in that is was for on are with as his they be at one have this from or had by hot but some what there we can out other were all your when up use word how said an each she".split()


def long_text(n=150_000):
    return " ".join(WORDS[(k * k + k // 7) % len(WORDS)] + str(k % 11) for k in range(n))


def rows():
    good = "\n".join(" ".join(WORDS[(k * 7 + j) % len(WORDS)] for k in range(14)) + "." for j in range(6))
    bad = "\n".join(" ".join(w.upper() + "!!" for w in WORDS[j : j + 9]) for j in range(6))
    out = [(k, f"{good} w{k % 17}", ["en", "de", None][k % 3], f"s{k % 3}", 10) for k in range(60)]
    out += [(100 + k, f"{bad} W{k % 13}!!", "de", None, None) for k in range(30)]
    out += [(None, None, None, None, None), (None, "x", None, None, None), (201, "", "en", "s", 0), (202, " \n\t ", "en", "s", 4), (203, None, "en", None, None), (203, None, "en", None, None)]
    out += [(204, "...!?", None, "s", 5), (205, good, "en", "s", 1), (205, good, "en", "s", 1), (206, good, "en", "t", 1), (207, "日本語のテキスト é ı ſ 𝒳", None, "s", 3), (208, "\x00 a\rb\x1cc", "en", "s", 3)]
    return out + [(209, long_text(), "en", "s", None)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), DOCS)
    stamp = datetime.datetime(2024, 1, 1)
    extra = {c: F.lit(7) if k % 2 else F.lit("clash") for k, c in enumerate(CLASH)}
    return df.withColumns(extra | {"nested": F.struct(F.lit(1).alias("fp"), F.array(F.lit(None).cast("string")).alias("row")), "at": F.lit(stamp)}).persist()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(100 + k, 0, 0) for k in range(30)] + [(None, 1, None), (5, None, 1), (6, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(0, " ".join(WORDS[3:23])), (1, None), (2, ""), (3, "two words"), (None, "far away there lived nobody at all here")], "item_id long, text string")


N = len(rows())


def run_all(docs, labels, benchmark, pages):
    model = secrets.trained(docs)
    return {
        "media": media.media_features(docs),
        "packing": packing.pack(docs, tokenizer_path()),
        "langid": langid.identify(docs, langid.profiles(docs)),
        "simhash": simhash.near_duplicates(docs),
        "leaks": decontaminate.find_leaks(docs, benchmark),
        "quality": quality.score_lines(docs, quality.learned(docs, labels)),
        "urls": urlfilter.judge(pages, URL_RULES, URL_BLOCKED),
        "secrets": secrets.scan(docs, model),
        "shards": sharding.shard_documents(docs),
        "warc": warc.round_trip(pages),
    }


def test_operators_on_awkward_rows(spark, docs, labels, benchmark):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("HTTP://A.example.com/en/7"), F.col("text")).alias("url"), F.col("text").alias("html"), *(c for c in CLASH))
    out = {k: df.collect() for k, df in run_all(docs, labels, benchmark, pages).items()}
    assert {k: len(v) for k, v in out.items() if k not in ("packing", "leaks")} == dict.fromkeys(("media", "langid", "simhash", "quality", "urls", "secrets", "shards", "warc"), N)
    assert sum(r.start == 0 for r in out["packing"]) == N
    assert {r.doc_id: r.lang_pred for r in out["langid"]}[204] == "und"
    assert all(0 <= r.score <= 1 for r in out["quality"]) and all(r.predicted in (0, 1) for r in out["quality"])
    assert {r.component_id for r in out["simhash"] if r.doc_id in (201, 202, 203)} == {201}
    blank = [r for r in out["media"] if r.doc_id == 203]
    assert len(blank) == 2 and blank[0] == blank[1] and (blank[0].n_bytes, blank[0].payload_bytes) == (0, 64)
    sizes = {}
    for r in out["shards"]:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(24)) <= 1


def test_operators_on_no_rows(spark, docs, labels, benchmark):
    none, pages = docs.limit(0), spark.createDataFrame([], "page_id long, url string, html string")
    assert {k: df.count() for k, df in run_all(none, labels.limit(0), benchmark.limit(0), pages).items()} == dict.fromkeys(("media", "packing", "langid", "simhash", "leaks", "quality", "urls", "secrets", "shards", "warc"), 0)


@pytest.mark.parametrize("which", ["full", "empty"])
def test_stages_on_awkward_rows(spark, docs, labels, benchmark, tmp_path, which):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    given = docs if which == "full" else docs.limit(0)
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, given, f"file://{tmp_path}")
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        out = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
            assert out.count() <= given.count()
        elif which == "empty":
            assert out.count() == 0


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e")] * 3 + [(None, "a b c d e"), (2, "quite other words stand here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.deduplicated(df).collect()) == [1, 2]


def test_sweep_and_shared_folder(spark):
    from playlog.llm import common

    common.sweep(spark)
    df = common.stage(spark.range(3), "sweep")
    assert df.count() == 3 and df.inputFiles()[0].startswith(common.shared_dir(spark))
    assert common.sweep(spark) == 1 and common.sweep(spark) == 0


@pytest.mark.parametrize("span", [1 << 17, 3])
def test_ranks_are_gapless(spark, span, monkeypatch):
    from playlog.llm import common
    from playlog.llm.common import ranked

    monkeypatch.setattr(common, "RANGE", span)
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") < 150, "hot").otherwise(None).alias("g"))
    out = ranked(df, ["g"], F.col("id"), (F.col("id") % 7).cast("int"), "r").collect()
    for g in ("hot", None):
        assert sorted(r.r for r in out if r.g == g) == list(range(150 if g else 50))


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from playlog.llm.common import pieces

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 100 + ["y" * 5000] + ["z"] * 50)], ["t"])
    parts = list(pieces(iter([batch, batch.slice(0, 0)]), 600))
    assert [t for p in parts for t in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert all(p.nbytes <= 600 or p.num_rows == 1 for p in parts)


def test_new_operators_on_awkward_rows(spark, docs):
    out = {}
    for r in infill.infilled(docs).withColumn("again", infill.restored()).select("doc_id", "n", "form", "again").collect():
        out.setdefault(r.doc_id, []).append(r)
    for k, text, *_ in rows():
        assert any((r.n, r.again) == (len(text or ""), text or "") for r in out[k])
    conversations = docs.select(F.when(F.col("doc_id") < 60, F.col("doc_id") % 7).otherwise(F.col("doc_id")).alias("conv_id"), (F.col("doc_id") % 5).alias("turn"), F.col("lang").alias("role"), "text", *CLASH)
    ids = {r.conv_id for r in conversations.select("conv_id").distinct().collect()}
    assert sorted(map(str, (r.conv_id for r in repair.summarised(repair.damaged(conversations)).collect()))) == sorted(map(str, ids))
    back = chat.read_back(chat.windows(conversations)).collect()
    assert {r.conv_id for r in back} == ids and sum(r.n_turns for r in back) == N


def test_new_operators_on_no_rows(spark, docs):
    none = docs.limit(0)
    talk = none.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text")
    assert [df.count() for df in (infill.infilled(none), repair.summarised(repair.damaged(talk)), repair.repaired(repair.as_turns(talk)), chat.windows(talk), chat.read_back(chat.windows(talk)))] == [0] * 5
