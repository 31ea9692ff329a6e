"""The corpus-source registry as a DataFrame.

A registry row names one XML corpus file and its audio repository.  The built-in
registry lists the supported Puyuma sources; :func:`registry_from_corpora` builds the
same shape from any DataFrame of ``(corpus_slug, dialects)`` rows, so registries
derived from data use the same code path.  The hosting organisation and the base URLs
have no defaults: callers pass a :class:`Host`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.urls import url_quote

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's registry for identical keys, paths and
# URLs).  Corpus slugs and their dialects in generator order, then the dictionary
# source; groups, audio modes and path patterns.
EPARK_GROUP = "ePark"
DICT_GROUP = "ILRDF_Dicts"
EPARK_AUDIO_MODE = "diarized"
DICT_AUDIO_MODE = "segmented"
LANGUAGE_DIR = "Puyuma"
DICT_CORPUS = "Puyuma"
DICT_DIALECT = "Nanwang"
DICT_XML_PATH = "ILRDF_Dicts/XML/Puyuma/Puyuma.xml"
DICT_AUDIO_REPO_NAME = "ILRDF_Dict_Puyuma"
FOUR_DIALECTS = ("Jianhe", "Nanwang", "Xiqun", "Zhiben")
EPARK_CORPORA = (
    ("hui_ben_ping_tai_picture_book_platform", ("Nanwang",)),
    ("jiu_jie_jiao_cai_nine_level_materials", FOUR_DIALECTS),
    ("ju_xing_pian_gao_zhong_sentence_patterns_senior_high", FOUR_DIALECTS),
    ("ju_xing_pian_guo_zhong_sentence_patterns_junior_high", FOUR_DIALECTS),
    ("qing_jing_zu_yu_contextual_indigenous_language", FOUR_DIALECTS),
    ("sheng_huo_hui_hua_pian_daily_conversation", FOUR_DIALECTS),
    ("tu_hua_gu_shi_pian_picture_story", FOUR_DIALECTS),
    ("wen_hua_pian_cultural_section", FOUR_DIALECTS),
    ("xue_xi_ci_biao_learning_vocabulary", FOUR_DIALECTS),
    ("yue_du_shu_xie_pian_reading_writing", FOUR_DIALECTS),
    ("zu_yu_duan_wen_indigenous_language_essays", FOUR_DIALECTS),
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Host:
    """Where the corpora are hosted: the organisation that owns the audio repositories,
    the base URL of the raw XML files (``{xml_base}/{xml_relative_path}``) and that of the
    audio repositories (``{hub_base}/{audio_repo}/resolve/main/...``)."""

    org: str
    xml_base: str
    hub_base: str


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("source_ord", T.IntegerType(), False),
        T.StructField("group", T.StringType(), False),
        T.StructField("corpus_slug", T.StringType(), False),
        T.StructField("dialect", T.StringType(), False),
        T.StructField("xml_relative_path", T.StringType(), False),
        T.StructField("audio_repo", T.StringType(), False),
        T.StructField("audio_mode", T.StringType(), False),
    ]
)

CORPORA_SCHEMA = "corpus_ord int, corpus_slug string, dialects array<string>"


def epark_xml_path(corpus: Column, dialect: Column) -> Column:
    return F.concat(F.lit("ePark/XML/"), corpus, F.lit(f"/{LANGUAGE_DIR}/"), dialect, F.lit(f"_{LANGUAGE_DIR}.xml"))


def registry_from_corpora(corpora: DataFrame, dictionary: DataFrame, *, org: str) -> DataFrame:
    """Registry rows from ``(corpus_ord, corpus_slug, dialects)`` ePark corpora followed
    by ``dictionary`` rows ``(corpus_slug, dialect, xml_relative_path)``.

    ``source_ord`` follows generator order: corpora by ``corpus_ord`` then dialect
    position, the dictionary sources after them.  The registry is small by nature
    (one row per corpus file); the running ordinal is a window over that small set."""
    ep = corpora.select(
        F.lit(0).alias("_block"),
        "corpus_ord",
        F.posexplode("dialects").alias("_dpos", "dialect"),
        "corpus_slug",
    ).select(
        "_block",
        F.col("corpus_ord").cast("long").alias("_o1"),
        F.col("_dpos").cast("long").alias("_o2"),
        F.lit(EPARK_GROUP).alias("group"),
        "corpus_slug",
        "dialect",
        epark_xml_path(F.col("corpus_slug"), F.col("dialect")).alias("xml_relative_path"),
        F.concat(F.lit(f"{org}/ePark_"), F.col("corpus_slug")).alias("audio_repo"),
        F.lit(EPARK_AUDIO_MODE).alias("audio_mode"),
    )
    dc = dictionary.select(
        F.lit(1).alias("_block"),
        F.lit(0).cast("long").alias("_o1"),
        F.lit(0).cast("long").alias("_o2"),
        F.lit(DICT_GROUP).alias("group"),
        "corpus_slug",
        "dialect",
        "xml_relative_path",
        F.concat(F.lit(f"{org}/ILRDF_Dict_"), F.col("corpus_slug")).alias("audio_repo"),
        F.lit(DICT_AUDIO_MODE).alias("audio_mode"),
    )
    w = Window.orderBy("_block", "_o1", "_o2", "corpus_slug", "dialect", "xml_relative_path")
    return (
        ep.unionByName(dc)
        .withColumn("source_ord", (F.row_number().over(w) - 1).cast("int"))
        .select([f.name for f in REGISTRY_SCHEMA.fields])
    )


def supported_sources(spark: SparkSession, *, org: str) -> DataFrame:
    """The 42 built-in sources (41 ePark corpus files, then the dictionary)."""
    corpora = spark.createDataFrame(
        [(i, slug, list(dialects)) for i, (slug, dialects) in enumerate(EPARK_CORPORA)], CORPORA_SCHEMA
    )
    dictionary = spark.createDataFrame(
        [(DICT_CORPUS, DICT_DIALECT, DICT_XML_PATH)], "corpus_slug string, dialect string, xml_relative_path string"
    )
    return registry_from_corpora(corpora, dictionary, org=org)


def with_source_paths(registry: DataFrame, host: Host) -> DataFrame:
    """Add the derived properties: ``source_key``, ``xml_url``, ``audio_repo_slug``,
    ``audio_base_url``, ``local_xml_relative_dir``."""
    return registry.select(
        "*",
        source_key(F.col("group"), F.col("corpus_slug"), F.col("dialect")).alias("source_key"),
        F.concat(F.lit(host.xml_base + "/"), F.col("xml_relative_path")).alias("xml_url"),
        F.regexp_extract(F.col("audio_repo"), r"^[^/]*/(.*)$", 1).alias("audio_repo_slug"),
        F.concat(F.lit(host.hub_base + "/"), F.col("audio_repo")).alias("audio_base_url"),
        F.regexp_replace(F.col("xml_relative_path"), r"/?[^/]*$", "").alias("local_xml_relative_dir"),
    )


def first_sources(registry: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of the registry by ``source_ord`` (all for None).  Counts
    positions, so a filtered registry works too."""
    if limit is None:
        return registry
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source_ord"))  # a row per corpus file
    return registry.withColumn("_place", place).where(F.col("_place") <= max(int(limit), 0)).drop("_place")


def source_key(group: Column, corpus_slug: Column, dialect: Column) -> Column:
    return F.concat_ws("/", group, corpus_slug, dialect)


def source_listing(registry: DataFrame) -> DataFrame:
    """One tab-separated line per source: key, XML path, audio repository."""
    key = source_key(F.col("group"), F.col("corpus_slug"), F.col("dialect"))
    return registry.select("source_ord", F.concat_ws("\t", key, "xml_relative_path", "audio_repo").alias("line"))


def audio_url(
    group: Column, audio_repo: Column, dialect: Column, audio_file: Column, *, hub_base: str
) -> Column:
    """Download URL of one audio file: ePark audio sits in a per-dialect folder."""
    head = F.concat(F.lit(hub_base + "/"), audio_repo, F.lit("/resolve/main/"))
    nested = F.concat(F.lit(f"{LANGUAGE_DIR}/"), dialect, F.lit(f"_{LANGUAGE_DIR}/"))
    return F.concat(head, F.when(group == EPARK_GROUP, nested).otherwise(F.lit("")), url_quote(audio_file))


def local_audio_dir(audio_root: Column | str, group: Column, audio_repo_slug: Column, dialect: Column) -> Column:
    """Local audio folder of a source: ``root/repo_slug[/Puyuma/{dialect}_Puyuma]``."""
    root = F.lit(audio_root.rstrip("/")) if isinstance(audio_root, str) else audio_root
    nested = F.concat(F.lit(f"/{LANGUAGE_DIR}/"), dialect, F.lit(f"_{LANGUAGE_DIR}"))
    return F.concat(root, F.lit("/"), audio_repo_slug, F.when(group == EPARK_GROUP, nested).otherwise(F.lit("")))


def local_xml_path(xml_root: str, xml_relative_path: Column) -> Column:
    return F.concat(F.lit(xml_root.rstrip("/") + "/"), xml_relative_path)
