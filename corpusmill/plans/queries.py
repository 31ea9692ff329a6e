"""Registered queries: one per operator of the survey's inventory.  Each takes
``(spark, sf_dir)``, reads the driver's tables (or data Spark derives from them)
and returns a DataFrame whose columns match the DuckDB oracle in
:mod:`corpusmill.plans.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.hashing import split_bucket
from corpusmill.functions.text import norm
from corpusmill.operators import dedupe as D
from corpusmill.operators import manifest as M
from corpusmill.operators import modeldata as MD
from corpusmill.operators import speech as SP
from corpusmill.operators import split as S
from corpusmill.operators import summary as A
from corpusmill.operators.joins import broadcast_if_small
from corpusmill.plans import adapter, jobs
from corpusmill.session import scratch_path
from corpusmill.sinks.named_files import read_named_files, write_named_files
from corpusmill.sources.files import file_inventory
from corpusmill.sinks import writers as W
from corpusmill.sources import jsonl as J
from corpusmill.sources import registry as R
from corpusmill.sources import xml as X
from corpusmill.sources.csv_records import read_csv
from corpusmill.sources.xml_split import split_sentences

ORDER = list(adapter.ORDER)
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _ex(spark: SparkSession, sf: str, *, texts: bool = False) -> DataFrame:
    return adapter.load_examples(spark, sf, texts=texts)


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.raw_examples(adapter.documents(spark, sf))


def translation_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return M.translation_manifest(_ex(spark, sf, texts=True), ORDER, keep=ORDER)


def tts_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return M.tts_manifest(_ex(spark, sf, texts=True), ORDER, keep=ORDER)


@query
def examples_table(spark, sf):
    return _ex(spark, sf, texts=True)


@query
def record_count(spark, sf):
    return _ex(spark, sf).agg(F.count(F.lit(1)).alias("record_count"))


@query
def derived_columns(spark, sf):
    return _ex(spark, sf).select("doc_id", "sent_pos", "source_text", "source_phonetic", "target_text")


@query
def duration(spark, sf):
    return _ex(spark, sf).select("doc_id", "sent_pos", "duration_seconds")


@query
def default_fill(spark, sf):
    return _ex(spark, sf).select("doc_id", "sent_pos", "language_code", "audio_mode")


@query
def record_key(spark, sf):
    return _ex(spark, sf).groupBy("record_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc_id"))


@query
def text_normalize(spark, sf):
    r = _raw(spark, sf)
    return r.select(
        "doc_id", "sent_pos",
        norm("form_raw").alias("norm_form"), norm("transl_raw").alias("norm_transl"),
        norm(norm("form_raw")).alias("norm2_form"),
    )


@query
def row_text(spark, sf):
    r = _raw(spark, sf)
    from corpusmill.functions.text import row_text as rt

    return r.select(
        "doc_id", "sent_pos", rt(F.col("form_raw")).alias("rt_form"), rt(F.col("doc_id")).alias("rt_doc"),
        rt(F.col("sent_pos") * 1000 + F.col("doc_id")).alias("rt_num"), rt(F.lit(None)).alias("rt_null"),
    )


@query
def dedupe_translation(spark, sf):
    ex = _ex(spark, sf, texts=True).select(*ORDER, D.translation_key().alias("dedupe_key"))
    kept = D.dedupe_first(adapter.computed_once(ex, "dedupe_key"), F.col("dedupe_key"), ORDER)
    return kept.select("doc_id", "sent_pos", "source_ord", "dedupe_key")


@query
def dedupe_tts(spark, sf):
    ex = _ex(spark, sf).select(*ORDER, D.tts_key().alias("dedupe_key"))
    kept = D.dedupe_first(ex, F.col("dedupe_key"), ORDER)
    return kept.select("doc_id", "sent_pos", "source_ord", "dedupe_key")


@query
def dedupe_first(spark, sf):
    ex = _ex(spark, sf).select("record_id", *ORDER)
    return D.dedupe_first(ex, F.col("record_id"), ORDER).select("record_id", "doc_id", "sent_pos")


@query
def dedupe_counts(spark, sf):
    return D.dedupe_counts_many(_ex(spark, sf, texts=True), {"translation": D.translation_key(), "tts": D.tts_key()})


@query
def manifest_translation(spark, sf):
    return translation_manifest(spark, sf)


@query
def manifest_tts(spark, sf):
    return tts_manifest(spark, sf)


@query
def split_bucket_q(spark, sf):
    return _ex(spark, sf, texts=True).select("doc_id", "sent_pos", split_bucket(D.translation_key()).alias("bucket"))


@query
def split_rows(spark, sf):
    ex = _ex(spark, sf)
    return S.split_rows(ex, F.col("record_id"), 0.8, 0.1).select("doc_id", "sent_pos", "split")


@query
def split_translation(spark, sf):
    return S.split_translation(translation_manifest(spark, sf)).select("record_id", "doc_id", "sent_pos", "split")


@query
def split_tts(spark, sf):
    return S.split_tts(tts_manifest(spark, sf)).select("record_id", "doc_id", "sent_pos", "split")


@query
def split_counts(spark, sf):
    return A.manifest_split_counts(_ex(spark, sf, texts=True), ORDER)


@query
def split_lookup(spark, sf):
    ex = _ex(spark, sf).select("record_id", "doc_id", "sent_pos", F.struct(*ORDER).alias("_ord"))
    return S.last_records(ex, "_ord").select(
        F.col("_id").alias("record_id"), F.col("_last.doc_id").alias("last_doc_id"), F.col("_last.sent_pos").alias("last_sent_pos"),
        F.col("_n").alias("n_rows"),
    )


@query
def split_records(spark, sf):
    ex = _ex(spark, sf, texts=True).select("record_id", "doc_id", "sent_pos", F.struct(*ORDER).alias("_ord"), D.translation_key().alias("_key"))
    out = S.split_records(ex, F.col("_key"), "_ord")
    return out.select(
        "split", F.col("row_ord.doc_id").alias("row_doc_id"), F.col("row_ord.sent_pos").alias("row_sent_pos"),
        "record_id", "doc_id", "sent_pos",
    )


@query
def summary_totals(spark, sf):
    return A.summary_totals(_ex(spark, sf))


@query
def summary_facets(spark, sf):
    return A.summary_facets(_ex(spark, sf))


# --------------------------------------------------------------------------- summaries
def _ord_key() -> Column:
    """First-seen order: source, document, sentence."""
    return F.struct(*ORDER)


@query
def summary_markdown(spark, sf):
    return A.summary_markdown_from_examples(_ex(spark, sf))


@query
def stats_manifest(spark, sf):
    tm = translation_manifest(spark, sf).withColumn("ord", _ord_key())
    totals, _ = A.stats_manifest(tm, order="ord")
    return totals.drop("n_durations").withColumn("total_duration_seconds", F.round("total_duration_seconds", 6))


@query
def stats_manifest_facets(spark, sf):
    tm = translation_manifest(spark, sf).withColumn("ord", _ord_key())
    _, facets = A.stats_manifest(tm, order="ord")
    return facets.select("*", *(F.col(f"first_ord.{c}").alias(f"first_{c}") for c in ORDER)).drop("first_ord")


# --------------------------------------------------------------------------- registry

AUDIO_ROOT = "data/raw/audio"
#: Folders that the audio files of :func:`audio_files` are dealt to.
AUDIO_SHARDS = 1024


def _registry(spark, sf):
    return R.with_source_paths(adapter.registry_from_documents(adapter.documents(spark, sf)), adapter.HOST)


@query
def source_registry(spark, sf):
    return _registry(spark, sf)


@query
def source_listing(spark, sf):
    return R.source_listing(adapter.registry_from_documents(adapter.documents(spark, sf)))


@query
def source_paths(spark, sf):
    reg = _registry(spark, sf)
    return reg.select(
        "source_ord", "source_key", "xml_url", "audio_base_url", "audio_repo_slug", "local_xml_relative_dir",
        R.local_xml_path("data/raw/xml", F.col("xml_relative_path")).alias("local_xml_path"),
        R.local_audio_dir(AUDIO_ROOT, F.col("group"), F.col("audio_repo_slug"), F.col("dialect")).alias("local_audio_dir"),
    )


@query
def audio_url(spark, sf):
    ex = _ex(spark, sf).where(F.col("audio_file") != "")
    reg = broadcast_if_small(_registry(spark, sf).select("source_key", "audio_repo"), size=adapter.load_registry(spark, sf)[1])
    j = ex.join(reg, "source_key")
    return j.select(
        "doc_id", "sent_pos",
        R.audio_url(F.col("group"), F.col("audio_repo"), F.col("dialect"), F.col("audio_file"), hub_base=adapter.HOST.hub_base).alias("audio_url"),
    )


@query
def audio_path_resolve(spark, sf):
    tm = tts_manifest(spark, sf)
    return SP.resolve_audio_path(tm, AUDIO_ROOT).select("doc_id", "sent_pos", "audio_path", "problem")


def _audio_inventory(spark, sf):
    """Audio files "on disk", derived from the data: the resolved audio path of every
    example with an audio file, present when its content hash falls below 0.8."""
    ex = _ex(spark, sf).where(F.col("audio_file") != "")
    paths = SP.resolve_audio_path(ex, AUDIO_ROOT).select(F.col("audio_path").alias("path")).distinct()
    present = paths.where(split_bucket(F.col("path")) < F.lit(0.8))
    return present.select("path", F.encode(F.concat(F.lit("RIFF:"), F.col("path")), "UTF-8").alias("content")).withColumn(
        "length", F.octet_length("content").cast("long")
    )


@query
def audio_missing(spark, sf):
    tm = tts_manifest(spark, sf)
    return SP.audio_missing(tm, _audio_inventory(spark, sf), AUDIO_ROOT).select("doc_id", "sent_pos", "audio_path", "problem")


@query
def audio_materialize(spark, sf):
    tm = tts_manifest(spark, sf)
    out = SP.audio_materialize(tm, _audio_inventory(spark, sf), AUDIO_ROOT)
    return out.select(
        "audio_file", "audio_path", F.octet_length("content").cast("long").alias("n_bytes"),
        F.sha2(F.col("content"), 256).alias("content_sha256"),
    )


@query
def audio_files(spark, sf):
    """The referenced audio, written as files by name and listed again.  Names lie in
    ``AUDIO_SHARDS`` folders by their hash, so that tasks list and read them."""
    folder = scratch_path(spark, "wavs")
    found = SP.audio_materialize(tts_manifest(spark, sf), _audio_inventory(spark, sf), AUDIO_ROOT)
    shard = F.pmod(F.xxhash64("audio_file"), F.lit(AUDIO_SHARDS)).cast("string")
    write_named_files(found.select(F.concat(shard, F.lit("/"), "audio_file").alias("name"), "content"), folder)
    files = read_named_files(spark, folder)
    return files.select(
        F.regexp_extract("name", "(?s)^[0-9]+/(.*)$", 1).alias("audio_file"), F.col("length").alias("n_bytes"),
        F.sha2(F.col("content"), 256).alias("content_sha256"),
    )


@query
def download_plan(spark, sf):
    reg = adapter.registry_from_documents(adapter.documents(spark, sf))
    ex = _ex(spark, sf)
    wanted = SP.download_plan(reg, ex, adapter.HOST, spark.createDataFrame([], "path string, length long"),
                              xml_root="data/raw/xml", audio_root=AUDIO_ROOT)
    # Files already on disk, derived from the data: a content-hash share of the
    # targets exists, some of them empty (length 0, so fetched again).
    b = split_bucket(F.col("dest"))
    inventory = wanted.where(b < F.lit(0.5)).select(
        F.col("dest").alias("path"), F.when(b < F.lit(0.1), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("length")
    )
    return SP.download_plan(reg, ex, adapter.HOST, inventory, xml_root="data/raw/xml", audio_root=AUDIO_ROOT)


@query
def ljspeech_metadata(spark, sf):
    tm = tts_manifest(spark, sf)
    return SP.ljspeech_rows(tm, ORDER)


@query
def ljspeech_counts(spark, sf):
    return SP.ljspeech_counts(tts_manifest(spark, sf))


@query
def audio_inventory(spark, sf):
    """An inventory of files that Spark wrote from the documents: the manifest's record
    ids as lines, in a folder a split; listed without being read."""
    path = scratch_path(spark, "inventory")
    S.split_translation(translation_manifest(spark, sf)).select("record_id", "split").write.partitionBy("split").text(path)
    files = file_inventory(spark, path, "part-*")
    split = F.regexp_extract("rel_path", r"^split=([^/]+)/[^/]+$", 1)
    return files.groupBy(split.alias("split")).agg(F.sum("length").cast("long").alias("n_bytes"))


# --------------------------------------------------------------------------- XML


def _xml_examples(spark, sf):
    docs = adapter.documents(spark, sf)
    files = adapter.xml_files_from_documents(docs)
    registry, size = adapter.load_registry(spark, sf)
    ex = X.load_corpus(files, registry, adapter.HOST, xml_root=adapter.XML_ROOT, registry_bytes=size)
    return ex.withColumn("doc_id", F.regexp_extract("file_path", r"part-0*([0-9]+)\.xml$", 1).cast("long"))


def _xml_sentences(spark, sf):
    files = adapter.xml_files_from_documents(adapter.documents(spark, sf))
    return X.extract_sentences(files, keep=("doc_id",))


@query
def xml_extract(spark, sf):
    s = _xml_sentences(spark, sf)
    return s.select(
        "doc_id", "sent_pos", "sentence_id", "language_code", "root_source_label", "citation", "copyright",
        "bibtex_citation", "root_glottocode", "original_form", "standard_form", "original_phonetic",
        "standard_phonetic", "translation_zh",
    )


@query
def xml_corpus_load(spark, sf):
    return _xml_examples(spark, sf).drop("file_path")


@query
def xml_child_pick(spark, sf):
    s = _xml_sentences(spark, sf)
    return s.select("doc_id", "sent_pos", "original_form", "standard_form", "original_phonetic", "standard_phonetic", "translation_zh")


@query
def xml_audio_pick(spark, sf):
    s = _xml_sentences(spark, sf)
    return s.select("doc_id", "sent_pos", "audio_file", "audio_url", "audio_start", "audio_end")


@query
def xml_split_scan(spark, sf):
    """Files of many documents each, written by Spark and read by as many tasks as there
    are splits."""
    path = scratch_path(spark, "large-xml")
    adapter.write_large_xml(adapter.documents(spark, sf), path)
    s = X.normalised(split_sentences(spark, path))
    return s.select(
        "sentence_id", "original_form", "standard_form", "original_phonetic", "standard_phonetic", "translation_zh", "audio_file",
        "audio_start", "audio_end", "root_glottocode", "language_code",
    )


# --------------------------------------------------------------------------- JSONL / CSV

_ORDER_FIELDS = (("source_ord", T.LongType()), ("doc_id", T.LongType()), ("sent_pos", T.LongType()))


@query
def jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "jsonl-translation")
    W.write_jsonl(translation_manifest(spark, sf), path)
    return J.read_jsonl(spark, path, J.manifest_schema(M.TRANSLATION_COLUMNS, _ORDER_FIELDS))


@query
def jsonl_scan(spark, sf):
    path = scratch_path(spark, "jsonl-tts")
    W.write_jsonl(tts_manifest(spark, sf), path)
    return J.read_jsonl(spark, path, J.manifest_schema(M.TTS_COLUMNS, _ORDER_FIELDS))


@query
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv-translation")
    W.write_csv(translation_manifest(spark, sf), path)
    back = read_csv(spark, path, [*M.TRANSLATION_COLUMNS, *(name for name, _ in _ORDER_FIELDS)])
    schema = J.manifest_schema(M.TRANSLATION_COLUMNS, _ORDER_FIELDS)
    return back.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.dataType != T.StringType() else F.col(f"`{f.name}`")).alias(f.name)
            for f in schema.fields
        ]
    )


@query
def line_places(spark, sf):
    """The manifest written in corpus order, and each line's place in the whole folder."""
    path = scratch_path(spark, "placed-translation")
    W.write_jsonl(translation_manifest(spark, sf).orderBy(*ORDER).select("record_id", "doc_id", "sent_pos"), path)
    row = F.from_json("value", "record_id string, doc_id long, sent_pos long", {"mode": "FAILFAST"})
    return J.numbered_lines(spark, path).select(row.alias("r"), "line_no").select("r.*", "line_no")


@query
def split_sink(spark, sf):
    path = scratch_path(spark, "split-translation")
    ordered = S.split_translation(translation_manifest(spark, sf)).withColumns({f"at_{c}": F.col(c) for c in ORDER})
    W.write_split_manifests(ordered, path, order=[f"at_{c}" for c in ORDER])
    schema = J.manifest_schema(M.TRANSLATION_COLUMNS, _ORDER_FIELDS + (("split", T.StringType()),))
    back = spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", path).json(path)
    return back.select("record_id", "doc_id", "sent_pos", "split")


@query
def record_coerce(spark, sf):
    from corpusmill.operators.examples import EXAMPLE_COLUMNS, record_coerce as coerce

    loose = translation_manifest(spark, sf).withColumn("audio_start", F.col("audio_start").cast("string"))
    return coerce(loose, keep=tuple(ORDER)).select(*EXAMPLE_COLUMNS, *ORDER)


@query
def safe_float(spark, sf):
    from corpusmill.functions.text import safe_float as sfl

    r = _raw(spark, sf)
    k = F.col("doc_id") + F.col("sent_pos")
    variants = F.array(
        F.concat(F.col("sent_pos").cast("string"), F.lit("_"), F.col("doc_id").cast("string")),
        F.concat(F.lit(" "), (k % 10).cast("string"), F.lit("."), F.col("sent_pos").cast("string"), F.lit("e"),
                 (k % 5).cast("string"), F.lit(" ")),
        F.when(k % 4 == 0, F.lit("-nan")).when(k % 4 == 1, F.lit("+Infinity")).when(k % 4 == 2, F.lit("1d")).otherwise(F.lit(".5")),
        F.col("form_raw"),
        F.when(k % 2 == 0, F.lit("1__0")).otherwise(F.lit("0x1p3")),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("\u3000"), F.col("doc_id").cast("string"), F.lit("."))),
    )
    v = r.select("doc_id", "sent_pos", F.posexplode(variants).alias("variant", "text")).withColumn("v", sfl(F.col("text")))
    return v.select(
        "doc_id", "sent_pos", F.col("variant").cast("long").alias("variant"),
        F.when(F.isnan("v"), F.lit(None)).otherwise(F.col("v")).alias("value"),
        F.coalesce(F.isnan("v"), F.lit(False)).alias("is_nan"),
    )


# --------------------------------------------------------------------------- jobs over files


def _manifest_files(spark, sf) -> str:
    path = scratch_path(spark, "job-translation")
    W.write_jsonl(translation_manifest(spark, sf).drop(*ORDER), path)
    return path


@query
def job_split(spark, sf):
    return jobs.split(spark, _manifest_files(spark, sf), scratch_path(spark, "job-split"))


@query
def job_stats(spark, sf):
    totals, facets = jobs.stats(spark, _manifest_files(spark, sf))
    head = totals.select(F.lit(-1).alias("facet_ord"), F.lit("missing_audio").alias("facet"), F.lit("").alias("key"), F.col("missing_audio").alias("n"))
    return head.unionByName(facets.select("facet_ord", "facet", "key", "n"))


# --------------------------------------------------------------------------- model data


def eval_pairs(spark, sf):
    """Evaluation pairs from the translation manifest: the reference is the whole
    target text, the prediction a damaged copy (function words dropped)."""
    tm = translation_manifest(spark, sf)
    pred = F.col("target_text")
    for w in (" de ", " the ", " le "):
        pred = F.replace(pred, F.lit(w), F.lit(" "))
    return tm.select(
        F.struct("doc_id", "sent_pos").alias("pair_id"),
        pred.alias("prediction"),
        F.col("target_text").alias("reference"),
    )


@query
def tokenize_pairs(spark, sf):
    tm = translation_manifest(spark, sf)
    return MD.tokenize_pairs(tm, keep=("doc_id", "sent_pos"))


@query
def label_restore(spark, sf):
    tm = translation_manifest(spark, sf)
    tok = MD.tokenize_pairs(tm, keep=("doc_id", "sent_pos"))
    padded = tok.select("doc_id", "sent_pos", MD.pad_labels(F.col("labels"), 256).alias("labels"))
    restored = padded.select(
        "doc_id", "sent_pos",
        F.size(F.filter("labels", lambda x: x == MD.IGNORE_INDEX)).cast("long").alias("n_masked"),
        MD.restore_labels(F.col("labels")).alias("ids"),
    )
    return restored.select("doc_id", "sent_pos", "n_masked", MD.decode_ids(F.col("ids")).alias("text"))


@query
def gen_len(spark, sf):
    return MD.gen_len(eval_pairs(spark, sf))


@query
def corpus_bleu(spark, sf):
    return MD.corpus_bleu(eval_pairs(spark, sf))


@query
def training_pairs(spark, sf):
    sp = S.split_translation(translation_manifest(spark, sf))
    return MD.training_pairs(sp, scratch_path(spark, "training-pairs")).select("split", "record_id", "doc_id", "sent_pos", "source_text", "target_text")


REGISTRY["split_bucket"] = REGISTRY.pop("split_bucket_q")
