"""SRC4 synthetic corpus generator (seeded, deterministic in any engine).

Each slot of a template is picked by ``md5('seed:id:slot')`` so the same id
always gives the same text, independent of partitioning.  Rows come from a
Spark-side id column (``spark.range`` or the ids of the rows being replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEED

# ---------------------------------------------------------------------------
# Templates and slot vocabularies of the synthetic generator.
# ---------------------------------------------------------------------------
TEMPLATES = [
    "Dalam perkembangan {topic} di Indonesia, {subject} memiliki peran penting dalam {context}.",
    "Menurut penelitian terbaru, {subject} di {location} menunjukkan peningkatan {metric} sebesar {percent}%.",
    "Pemerintah Indonesia melalui {institution} telah mengumumkan kebijakan baru terkait {topic}.",
    "{subject} merupakan salah satu aspek penting dalam pembangunan {sector} di era digital.",
    "Para ahli sepakat bahwa {topic} di Indonesia memerlukan perhatian khusus dari {institution}.",
    "Data terbaru menunjukkan bahwa {percent}% masyarakat Indonesia menggunakan {technology} dalam kehidupan sehari-hari.",
    "Sejarah mencatat bahwa {subject} telah berkembang signifikan sejak {year} di Indonesia.",
    "Inovasi dalam bidang {sector} terus didorong oleh {institution} untuk mencapai target {metric}.",
    "Masyarakat {location} dikenal dengan kearifan lokalnya dalam mengelola {topic} secara berkelanjutan.",
    "Perkembangan {technology} telah membawa dampak positif terhadap {sector} di Indonesia.",
]
TOPICS = ["pendidikan", "teknologi", "kesehatan", "ekonomi", "budaya", "pertanian", "maritim", "pariwisata"]
SUBJECTS = ["masyarakat lokal", "generasi muda", "UMKM", "startup teknologi", "komunitas seni"]
LOCATIONS = ["Jakarta", "Yogyakarta", "Surabaya", "Bandung", "Bali", "Makassar", "Medan"]
METRICS = ["produktivitas", "efisiensi", "kualitas", "partisipasi", "pertumbuhan"]
SECTORS = ["pendidikan", "kesehatan", "ekonomi digital", "pertanian berkelanjutan", "pariwisata"]
INSTITUTIONS = ["Kementerian Pendidikan", "Kementerian Kesehatan", "Kemendikbudristek", "BRIN", "Bappenas"]
TECHNOLOGIES = ["AI", "cloud computing", "IoT", "blockchain", "5G", "big data"]
PERCENT_RANGE = (5, 95)   # inclusive
YEAR_RANGE = (2020, 2025)  # inclusive

# slot name -> list of values (ranges are rendered as numbers)
SLOTS = [
    ("topic", TOPICS),
    ("subject", SUBJECTS),
    ("context", SECTORS),
    ("location", LOCATIONS),
    ("metric", METRICS),
    ("percent", [str(v) for v in range(PERCENT_RANGE[0], PERCENT_RANGE[1] + 1)]),
    ("institution", INSTITUTIONS),
    ("sector", SECTORS),
    ("technology", TECHNOLOGIES),
    ("year", [str(v) for v in range(YEAR_RANGE[0], YEAR_RANGE[1] + 1)]),
]


def _pick(values: list[str], id_col: Column, slot: str, seed: int) -> Column:
    key = F.concat(F.lit(f"{seed}:"), id_col.cast("string"), F.lit(f":{slot}"))
    idx = (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + F.lit(1))


def synthetic_text(id_col: Column, seed: int = SEED) -> Column:
    """Template text for one id; every slot chosen by its own md5 draw."""
    text = _pick(TEMPLATES, id_col, "template", seed)
    for slot, values in SLOTS:
        text = F.replace(text, F.lit("{" + slot + "}"), _pick(values, id_col, slot, seed))
    return text


def synthetic_rows(ids: DataFrame, lang: Column | str, id_col: str = "doc_id",
                   seed: int = SEED) -> DataFrame:
    """Synthetic replacement rows for a set of ids (source = 'synthetic')."""
    lang_c = F.lit(lang) if isinstance(lang, str) else lang
    return ids.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        synthetic_text(F.col(id_col), seed).alias("text"),
        lang_c.alias("lang"),
        F.lit("synthetic").alias("source"),
    )


def synthetic_corpus(spark: SparkSession, n: int, lang: str = "indonesian",
                     seed: int = SEED) -> DataFrame:
    """SRC4/SET3: ``n`` synthetic rows from ``spark.range`` (distributed)."""
    return synthetic_rows(spark.range(n).withColumnRenamed("id", "doc_id"), lang, "doc_id", seed)
