"""Building the kept dataset from images, annotations and verdicts, with its numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATH = ["institution", "study", "series", "file"]


def _kept(decision: Column, pending_as: str | None, uncertain_as: str | None) -> Column:
    """Whether an annotation stays; no verdict, or an open one that counts as nothing, does not."""
    final = F.when(decision == "pending", F.lit(pending_as)).when(decision == "uncertain", F.lit(uncertain_as)).otherwise(decision)
    return F.coalesce(final == "keep", F.lit(False))


def _once(verdicts: DataFrame, key: str, name: str) -> DataFrame:
    """A verdict a key, the least if there are several (verdicts are held to one a key by contracts)."""
    return verdicts.groupBy(F.col(key).alias(f"_{key}")).agg(F.min("decision").alias(name))


def build(images: DataFrame, annotations: DataFrame, verdicts: DataFrame, image_verdicts: DataFrame, pending_as: str | None = None, uncertain_as: str | None = None, losers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(images that stay, with their kept annotations as an array; one row of numbers).

    images has source_json, file_uid, PATH and image_path; annotations file_uid, annotation_uid, ann_index and annotation (a
    struct); verdicts annotation_uid and decision; image_verdicts file_uid and decision. Excluded images go with all they
    hold, and so do losers (file_uid), images that another dataset has too (J20). An image whose annotations all go stays:
    the population is the same. Numbers of annotations are of images that stay; unknown are those without a verdict,
    and open ones that count as nothing.
    """
    seen = images.join(_once(image_verdicts, "file_uid", "_image"), F.col("file_uid") == F.col("_file_uid"), "left").drop("_file_uid")
    if losers is not None:
        lost = losers.select(F.col("file_uid").alias("_lost")).distinct()
        seen = seen.join(lost, F.col("file_uid") == F.col("_lost"), "left")
    gone = F.coalesce(F.col("_image") == "exclude", F.lit(False))
    lost = F.col("_lost").isNotNull() if losers is not None else F.lit(False)
    seen = seen.withColumns({"_gone": gone, "_dup": lost & ~gone}).select(*images.columns, "_image", "_gone", "_dup")
    d = F.col("_decision")
    judged = annotations.join(_once(verdicts, "annotation_uid", "_decision"), F.col("annotation_uid") == F.col("_annotation_uid"), "left")
    judged = judged.withColumn("_keep", _kept(d, pending_as, uncertain_as))
    open_ = lambda name, policy: F.count_if(d == name) if policy not in ("keep", "exclude") else F.lit(0)
    own = judged.groupBy(F.col("file_uid").alias("_f")).agg(
        F.array_sort(F.collect_list(F.when(F.col("_keep"), F.struct("ann_index", "annotation_uid", "annotation")))).alias("_kept"), F.count("*").alias("_n"), F.count_if("_keep").alias("_k"),
        *[F.count_if(d == v).alias(f"_{v}") for v in ("keep", "exclude", "pending", "uncertain")],
        (F.count_if(d.isNull() | ~d.isin("keep", "exclude", "pending", "uncertain")) + open_("pending", pending_as) + open_("uncertain", uncertain_as)).alias("_unknown"),
    )
    whole = seen.join(own, F.col("file_uid") == F.col("_f"), "left")
    stays = ~F.col("_gone") & ~F.col("_dup")
    n, k = F.coalesce("_n", F.lit(0)), F.coalesce("_k", F.lit(0))
    total = lambda c: F.coalesce(F.sum(F.when(stays, F.col(c))), F.lit(0)).cast("long")
    numbers = whole.agg(
        F.count("*").alias("images_total"), F.count_if(F.col("_image") == "pending").alias("images_pending"), F.count_if("_gone").alias("images_dropped"), F.count_if("_dup").alias("duplicates_dropped"),
        F.count_if(stays).alias("files_total"), F.count_if(stays & (n > 0) & (k == 0)).alias("files_emptied"), F.count_if(stays & (n == 0)).alias("files_already_empty"),
        total("_keep").alias("kept"), total("_exclude").alias("excluded"), total("_pending").alias("pending"), total("_uncertain").alias("uncertain"), total("_unknown").alias("unknown"),
    )
    held = F.transform(F.coalesce("_kept", F.array().cast(whole.schema["_kept"].dataType)), lambda x: x["annotation"])
    return whole.filter(stays).select(*images.columns, held.alias("annotations")), numbers


def documents(built: DataFrame) -> DataFrame:
    """source_json and value, the nested documents of a build; containers without images are not there (U4)."""
    from adjudica.sources.artifacts import nested_documents

    flat = built.select("source_json", *PATH, "image_path", F.explode_outer("annotations").alias("annotation"))
    return nested_documents(flat)
