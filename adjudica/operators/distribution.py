"""The distribution of an exported sample set: counts for nine charts in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.storage import written

MASKS = ("pneumothorax_mask", "lung_mask", "thorax_mask")
#: Limits of the physical widths in mm, and the quarter decades that areas are held to (fixed values).
WIDTHS = (0, 200, 250, 300, 400, 10_000)
AREA_BINS = 20
SIDE_NOTE = "denominator = pneumothorax_case true"
WIDTH_NOTE = "chest radiographs are physically ~350 mm wide"


def _charts() -> list[tuple[str, str, str, str, Column]]:
    """chart, field, value, note and the condition whose rows are counted, for all charts but those by area and facility."""
    case = F.coalesce("pneumothorax_case", F.lit(False))
    has = lambda m: F.coalesce(F.length(F.col(f"{m}.pixel_array")) > 0, F.lit(False))
    is_ = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    masked, any_ = has("pneumothorax_mask"), F.lit(True)
    out = [("00_overview", "samples", "total", "", any_)]
    answers = {"Pneumothorax case": (case, ~case, ~any_), "Pneumothorax mask": (masked, ~any_, ~masked)}
    answers |= {name: tuple(is_(c, v) for v in ("present", "absent", "unknown")) for name, c in (("Abnormal finding", "abnormal_finding_status"), ("Bulla / bleb", "bulla_bleb_status"))}
    for name, tests in answers.items():
        out += [("01_label_counts", name, value, "", test) for value, test in zip(("present/true", "absent/false", "unknown/null"), tests)]
    for truth, test in (("true", case), ("false", ~case)):
        out += [("02_case_vs_mask", f"Pneumothorax case = {truth}", f"mask {value}", "", test & with_) for value, with_ in (("present", masked), ("absent", ~masked))]
    sides = ("right", "left", "bilateral")
    out += [("03_side", "pneumothorax_side", s, SIDE_NOTE, is_("pneumothorax_side", s)) for s in sides]
    for m in MASKS:
        out += [("04_mask_coverage", m, "present", "", has(m)), ("04_mask_coverage", m, "missing", "", ~has(m))]
    spaced = F.col("pixel_spacing").isNotNull()
    for name, known in (("view_position", F.col("view_position").isNotNull()), ("vendor_id", F.col("vendor_id").isNotNull()), ("pixel_spacing", spaced)):
        out += [("07_metadata", name, "present", "", known), ("07_metadata", name, "missing (null)", "", ~known)]
    for status in ("present", "absent", "unknown"):
        out += [("08_finding_vs_case", status, f"pneumothorax {truth}", "", is_("abnormal_finding_status", status) & test) for truth, test in (("true", case), ("false", ~case))]
    width = F.when(spaced & F.col("image_shape").isNotNull(), F.col("image_shape.width") * F.col("pixel_spacing.x"))
    for low, high in zip(WIDTHS, WIDTHS[1:]):
        inside = F.coalesce((width >= low) & (width < high), F.lit(False))
        out.append(("09_physical_width", "image_shape.width * pixel_spacing.x", f"[{low}, {high}) mm", WIDTH_NOTE, inside))
    return out


def distribution(samples: DataFrame) -> DataFrame:
    """chart, field, value, images and note: what the nine charts of a sample set show.

    samples have facility_id, patient_id, pneumothorax_case, pneumothorax_side, bulla_bleb_status, abnormal_finding_status,
    view_position, vendor_id, pixel_spacing (x, y), image_shape (height, width), pneumothorax_area_mm2 and masks with
    pixel_array. All is counted by facility and bin of area first, so the texts and masks of samples are read once and
    what is shuffled is a row for each of those and task. Missing truth is false; areas that are null or 0 are in no bin,
    those beyond the bins in the outermost; facility null is a facility. The counts of fixed values come with zeros, those
    of bins and facilities where there are any. Sides unknown are the cases that none of the three sides takes.
    """
    charts = _charts()
    area = F.col("pneumothorax_area_mm2").cast("double")
    bin_ = F.when(area > 0, F.least(F.greatest(F.floor(F.log10(area) * 4), F.lit(0)), F.lit(AREA_BINS - 1)).cast("int"))
    counts = samples.groupBy("facility_id", bin_.alias("_bin")).agg(*[F.count_if(test).alias(f"c{i}") for i, (*_, test) in enumerate(charts)])
    counts = written(counts, "distribution")
    fixed = [(chart, field, value, note) for chart, field, value, note, _ in charts]
    place = {names[:3]: f"c{i}" for i, names in enumerate(fixed)}
    case, masked, all_ = (F.col(place[p]) for p in (("01_label_counts", "Pneumothorax case", "present/true"), ("01_label_counts", "Pneumothorax mask", "present/true"), ("00_overview", "samples", "total")))

    def row(chart, field, value, images, note=""):
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(*[lit(x).cast("string").alias(n) for n, x in (("chart", chart), ("field", field), ("value", value))], F.coalesce(images, F.lit(0)).cast("long").alias("images"), F.lit(note).alias("note"))

    sums = counts.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(charts))])
    rows = [row(chart, field, value, F.col(f"c{i}"), note) for i, (chart, field, value, note) in enumerate(fixed)]
    rows.append(row("03_side", "pneumothorax_side", "unknown (null)", case - sum(F.col(place["03_side", "pneumothorax_side", s]) for s in ("right", "left", "bilateral")), SIDE_NOTE))
    flat = lambda df, *structs: df.select(F.inline(F.array(*structs)))
    by_bin = counts.filter("_bin is not null").groupBy("_bin").agg(F.sum(all_).alias("n"))
    edge = lambda b: F.format_string("%.0f", F.pow(F.lit(10.0), b / F.lit(4)))
    label = F.concat(F.lit("["), edge(F.col("_bin")), F.lit(", "), edge(F.col("_bin") + 1), F.lit(") mm2"))
    by_facility = counts.groupBy("facility_id").agg(F.sum(all_).alias("n"), F.sum(case).alias("p"), F.sum(masked).alias("m"))
    facility = [row("06_facility", F.col("facility_id"), value, F.col(c)) for value, c in (("images", "n"), ("pneumothorax true", "p"), ("pneumothorax mask", "m"))]
    who = F.struct("facility_id", "patient_id")
    # patients are distinct within facilities, so the hottest facility is split by patient
    patients = samples.groupBy("facility_id", "patient_id").agg(F.bool_or(F.coalesce("pneumothorax_case", F.lit(False))).alias("p")).agg(F.count(who).alias("n"), F.count_if("p").alias("p"))
    people = [row("00_overview", "patients", value, F.col(c)) for value, c in (("unique (facility, patient)", "n"), ("with pneumothorax", "p"))]
    return flat(sums, *rows).union(flat(by_bin, row("05_area", "pneumothorax_area_mm2", label, F.col("n")))).union(flat(by_facility, *facility)).union(flat(patients, *people))


def distribution_charts(counts: DataFrame, top: int = 10) -> DataFrame:
    """facility, place and the shares of cases with mask, without mask and of others: the largest facilities, the rest as one.

    counts is what distribution() gives; ties by name. A facility with more masks than cases has a negative middle share,
    as the chart that it feeds.
    """
    wide = counts.filter("chart = '06_facility'").groupBy("field").agg(*[F.max(F.when(F.col("value") == v, F.col("images"))).alias(c) for v, c in (("images", "n"), ("pneumothorax true", "p"), ("pneumothorax mask", "m"))])
    named = wide.orderBy(F.desc("n"), "field").limit(top).select(F.col("field").alias("_top"))
    # eqNullSafe: the facility without a name is one too
    j = wide.join(F.broadcast(named.withColumn("_in", F.lit(True))), F.col("field").eqNullSafe(F.col("_top")), "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
    out = j.groupBy(F.when(F.col("_in"), F.col("field")).alias("facility"), (~F.col("_in")).alias("other")).agg(F.count(F.lit(1)).alias("facilities"), *[F.sum(c).alias(c) for c in ("n", "p", "m")])
    share = lambda c: F.round(c * 100 / F.col("n"), 6)
    return out.select("facility", "other", "facilities", F.col("n").alias("images"), share(F.col("m")).alias("with_mask"), share(F.col("p") - F.col("m")).alias("without_mask"), share(F.col("n") - F.col("p")).alias("others"))
