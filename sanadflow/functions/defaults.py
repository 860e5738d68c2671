"""Default dimension tables: the works, the collections and their titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Works to extract, as (repository, path fragment that names author and work, title, death of the author AH).
WORKS = (
    ("0225AH", "CabdRazzaqSancani.Musannaf", "Musannaf Abd ar-Razzaq", 211),
    ("0225AH", "Tayalisi.Musnad", "Musnad at-Tayalisi", 204),
    ("0225AH", "Shafici.Musnad", "Musnad ash-Shafi'i", 204),
    ("0250AH", "IbnAbiShayba.Musannaf", "Musannaf Ibn Abi Shayba", 235),
    ("0250AH", "IbnMansurKhurasani.Sunan", "Sunan Sa'id ibn Mansur", 227),
    ("0300AH", "Bazzar.BahrZakhkhar", "Musnad al-Bazzar (al-Bahr az-Zakhkhar)", 292),
    ("0325AH", "AbuYaclaMawsili.Musnad", "Musnad Abu Ya'la", 307),
    ("0325AH", "IbnKhuzaymaNaysaburi.Sahih", "Sahih Ibn Khuzayma", 311),
    ("0375AH", "Tabarani.MucjamKabir", "al-Mu'jam al-Kabir", 360),
    ("0375AH", "Tabarani.MucjamAwsat", "al-Mu'jam al-Awsat", 360),
    ("0375AH", "Tabarani.MucjamSaghir", "al-Mu'jam as-Saghir", 360),
    ("0400AH", "Daraqutni.Sunan", "Sunan ad-Daraqutni", 385),
    ("0425AH", "HakimNaysaburi.Mustadrak", "al-Mustadrak ala as-Sahihayn", 405),
    ("0475AH", "Bayhaqi.SunanKubra", "as-Sunan al-Kubra (Bayhaqi)", 458),
    ("0475AH", "Bayhaqi.ShucabIman", "Shu'ab al-Iman", 458),
)
# Collections in the order in which they are published, with their titles.
COLLECTIONS = (
    ("bukhari", "Sahih al-Bukhari"), ("muslim", "Sahih Muslim"), ("abudawud", "Sunan Abi Dawud"), ("tirmidhi", "Jami' at-Tirmidhi"),
    ("nasai", "Sunan an-Nasa'i"), ("ibnmajah", "Sunan Ibn Majah"), ("malik", "Muwatta Malik"), ("ahmed", "Musnad Ahmad"),
)


def works(spark: SparkSession) -> DataFrame:
    """``repo, fragment, title, died_ah``."""
    return spark.createDataFrame(list(WORKS), "repo string, fragment string, title string, died_ah int")


def collections(spark: SparkSession) -> DataFrame:
    """``slug, title, ord``."""
    return spark.createDataFrame([(*c, i) for i, c in enumerate(COLLECTIONS)], "slug string, title string, ord int")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``topic, topic_ord, keyword`` of a lexicon file: a JSON object of topics with their keywords, in order."""
    import json

    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    rows = [(topic, i, word) for i, (topic, words) in enumerate(json.loads(text).items()) for word in words]
    return spark.createDataFrame(rows, "topic string, topic_ord int, keyword string")
