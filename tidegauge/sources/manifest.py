"""Manifests of raw files, from an inventory of paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import file_stem


def _manifest(files: DataFrame, dataset: str, base: str) -> DataFrame:
    """files: path, entity_id, modality (NULL: auxiliary)."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    place = F.when(
        F.col("modality").isNotNull(),
        F.concat(F.lit(f"{base}/entity="), F.col("entity_id"), F.lit("/modality="), F.col("modality"), F.lit("/"), name),
    ).otherwise(F.concat(F.lit(f"{base}/aux/"), name))
    kind = F.when(F.col("modality").isNotNull(), "files").otherwise("aux")
    return files.select(
        F.col("path").alias("local_path"),
        place.alias("s3_path"),
        F.lit(dataset).alias("dataset"),
        "entity_id",
        "modality",
        name.alias("file_name"),
        kind.alias("table"),
    )


#: Auxiliary files of the trial layout and their category.
AUXILIARY = {"meta_data.csv": "metadata", "subjects.csv": "metadata", "questionnaire.xlsx": "annotations"}


def trials(
    inventory: DataFrame,
    folders: dict[str, str],
    base: str,
    dataset: str = "trials",
    subjects: str = "subject",
    auxiliary: dict[str, str] | None = None,
) -> DataFrame:
    """Trial layout `<subject>/<folder>/<file>`: folders maps a folder's name to its modality.

    Subjects' folders begin with `subjects`. Of the other files only those named in `auxiliary` are taken, into the
    folder of their category, for the entity `global`; hidden files are none.
    """
    auxiliary = AUXILIARY if auxiliary is None else auxiliary
    subject = F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1)
    folder, name = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.regexp_extract("path", r"([^/]+)$", 1)
    pick = lambda column, table: F.coalesce(*[F.when(column == k, v) for k, v in table.items()], F.lit(None).cast("string"))
    mode = F.when(subject.startswith(subjects), pick(folder, folders))
    kind = F.when(mode.isNull(), pick(name, auxiliary))
    rows = inventory.select(
        "path",
        name.alias("file_name"),
        subject.alias("_subject"),
        mode.alias("_mode"),
        kind.alias("_kind"),
    ).filter("(_mode is not null or _kind is not null) and not startswith(file_name, '.')")
    place = F.when(
        F.col("_mode").isNotNull(), F.concat(
            F.lit(f"{base}/files/entity="),
            F.col("_subject"),
            F.lit("/modality="),
            F.col("_mode"),
            F.lit("/"),
            F.col("file_name"),
        )
    ).otherwise(F.concat(F.lit(f"{base}/auxiliary/"), F.col("_kind"), F.lit("/"), F.col("file_name")))
    return rows.select(
        F.col("path").alias("local_path"),
        place.alias("s3_path"),
        F.lit(dataset).alias("dataset"),
        F.when(F.col("_mode").isNotNull(), F.col("_subject")).otherwise("global").alias("entity_id"),
        F.coalesce("_mode", "_kind").alias("modality"),
        "file_name",
        F.when(F.col("_mode").isNotNull(), "files").otherwise("aux").alias("table"),
    )


def sessions(inventory: DataFrame, base: str, dataset: str = "sessions") -> DataFrame:
    """Session layout by folder: audio (id is the stem, dots as underscores), video (id before the first underscore), e4 and neurosky (folder is the id)."""
    folder = F.regexp_extract("path", r"(audio|video|e4|neurosky)[^/]*/", 1)
    stem, parent = file_stem(F.col("path")), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    entity = F.when(
        folder == "audio",
        F.regexp_replace(stem, r"\.", "_"),
    ).when(folder == "video", F.split(stem, "_")[0]).when(folder.isin("e4", "neurosky"), parent)
    mode = F.when(folder.isin("audio", "video"), folder).when(folder == "e4", "biosignal").when(folder == "neurosky", "eeg")
    return _manifest(inventory.select("path", entity.alias("entity_id"), mode.alias("modality")), dataset, base)
