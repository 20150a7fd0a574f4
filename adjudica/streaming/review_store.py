"""A store of review items that people edit: built from a manifest, edited by a stream with state, exported and imported again (SK16, A39).

An item is an image or an annotation, known by kind, dataset_id and key; none of these names a source file, so verdicts
find their items after a source was exported anew. The store is never the only copy of a verdict: exported() takes what
people said from it, and imported() puts that into a store built afresh.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adjudica.operators.review import DECIDED, SEED, SPOT_CHECK, TO_REPORT, effective_reasons, effective_status

KEYS = ["kind", "dataset_id", "key"]
#: What the state of an item holds; version counts the edits that took effect.
STATE_DDL = "version long, status string, reasons string, reason string, reviewer string, reviewed_at string, comment string, tags array<string>"
#: base is the version that the editor saw; field is status, reasons, comment, tag+ or tag-.
EDIT_DDL = "kind string, dataset_id string, key string, edit_id string, at string, reviewer string, base long, field string, value string"
HISTORY_DDL = f"kind string, dataset_id string, key string, edit_id string, outcome string, {STATE_DDL}"


def _no_tags() -> Column:
    return F.array().cast("array<string>")


def _human(tag: Column) -> Column:
    return tag.startswith("review:") | tag.startswith("reason:")


def _tags(machine: Column, status: Column, reasons: Column) -> Column:
    """Machine tags, then review: and reason: tags, the copies of the fields that people filter by."""
    named = F.transform(F.filter(F.split(F.coalesce(reasons, F.lit("")), r"\|"), lambda r: r != ""), lambda r: F.concat(F.lit("reason:"), r))
    return F.concat(machine, F.array(F.concat(F.lit("review:"), status)), named)


def _reasons(field: Column, tags: Column, text: Column) -> Column:
    """effective_reasons, blank where there are none."""
    return F.coalesce(F.nullif(effective_reasons(field, tags, text), F.lit("none")), F.lit(""))


def built(manifest: DataFrame) -> DataFrame:
    """The items of a manifest: KEYS, review_status, review_reasons ("a|b"), review_reason, reviewer, reviewed_at, auto_tags, spot_check.

    Machine tags are those of the manifest, whatever a store before had. baseline is the status of the manifest: what
    differs from it later was said by a person. Missing values are blank, a missing status pending.
    """
    blank = lambda c: F.coalesce(c, F.lit(""))
    status = F.coalesce("review_status", F.lit("pending"))
    spot = F.when(F.coalesce("spot_check", F.lit(False)), F.array(F.lit(SPOT_CHECK))).otherwise(_no_tags())
    tags = F.concat(_tags(F.coalesce("auto_tags", _no_tags()), status, F.col("review_reasons")), spot)
    return manifest.select(
        *KEYS, status.alias("baseline"), F.lit(0).cast("long").alias("version"), status.alias("status"), blank("review_reasons").alias("reasons"), blank("review_reason").alias("reason"),
        blank("reviewer").alias("reviewer"), blank("reviewed_at").alias("reviewed_at"), F.lit("").alias("comment"), tags.alias("tags"),
    )


def imported(items: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Items with the verdicts (KEYS, decision, reason, reviewer, reviewed_at, comment) of their keys, one a key at most.

    Reasons of the vocabulary go to the reasons, any other text to the reason. review: and reason: tags are replaced, all
    others kept. Verdicts without dataset_id fit nothing; imported_counts() says how many found an item.
    """
    known = _reasons(F.col("_v.reason"), F.lit(None).cast("array<string>"), F.lit(None).cast("string"))
    told = verdicts.filter(F.coalesce("dataset_id", F.lit("")) != "").select(*KEYS, F.struct("decision", "reason", "reviewer", "reviewed_at", "comment").alias("_v"))
    j = items.join(told, KEYS, "left").withColumn("_reasons", known)
    kept = F.filter("tags", lambda t: ~_human(t))
    new = {
        "status": F.col("_v.decision"), "reasons": F.col("_reasons"), "reason": F.when(F.col("_reasons") == "", F.coalesce("_v.reason", F.lit(""))).otherwise(""),
        **{c: F.coalesce(f"_v.{c}", F.lit("")) for c in ("reviewer", "reviewed_at", "comment")}, "tags": _tags(kept, F.col("_v.decision"), F.col("_reasons")),
    }
    return j.select(*[(F.when(F.col("_v").isNotNull(), new[c]).otherwise(F.col(c)) if c in new else F.col(c)).alias(c) for c in items.columns])


def imported_counts(items: DataFrame, verdicts: DataFrame) -> DataFrame:
    """kind and n of the items that a verdict was found for."""
    return items.join(verdicts.filter(F.coalesce("dataset_id", F.lit("")) != "").select(*KEYS).distinct(), KEYS, "left_semi").groupBy("kind").agg(F.count("*").alias("n"))


def exported(items: DataFrame, baseline: bool = True) -> DataFrame:
    """The verdicts of people alone: KEYS, decision, reason, reviewer, reviewed_at, comment.

    An item counts if it is decided and has a reviewer or, with a baseline, another status than that; machine verdicts
    and pending items never do. The status is that of the field, of a review: tag where the field is pending. A reviewer
    who left no name is `unknown`.
    """
    status = effective_status(F.col("status"), F.col("tags"))
    named = F.coalesce("reviewer", F.lit("")) != ""
    human = named | (status != F.col("baseline")) if baseline else named
    reasons = _reasons(F.col("reasons"), F.col("tags"), F.col("reason"))
    real = ~F.array_contains(F.coalesce("tags", _no_tags()), SEED)
    return items.filter(real & status.isin(*DECIDED) & F.coalesce(human, F.lit(False))).select(
        *KEYS, status.alias("decision"), reasons.alias("reason"), F.when(named, F.col("reviewer")).otherwise("unknown").alias("reviewer"), "reviewed_at", "comment")


def unexported(items: DataFrame, store: DataFrame, baseline: bool = True) -> DataFrame:
    """Verdicts that building the store anew would lose: those whose key the exported store lacks."""
    return exported(items, baseline).join(store.select(*KEYS).distinct(), KEYS, "left_anti")


def flagged(items: DataFrame) -> DataFrame:
    """Items to report, whatever their status."""
    tags = F.coalesce("tags", _no_tags())
    return items.filter(F.array_contains(tags, TO_REPORT) & ~F.array_contains(tags, SEED))


class Edits(StatefulProcessor):
    """Applies edits to items, each in its own state; says of each edit what became of it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.item = handle.getValueState("item", STATE_DDL)
        self.changes = handle.getListState("changes", "place string, version long, reviewer string, value string")
        self.seen = handle.getListState("seen", "edit_ids array<string>")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N803
        self.item.update(tuple(initialState[c] for c in _STATE))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        """The state is read and written once for all edits of an item in a batch: each call goes to the state server and back."""
        edits = sorted((dict(zip(r.__fields__, r)) for r in rows), key=lambda r: (r["at"] or "", r["edit_id"] or ""))
        held = dict(zip(_STATE, self.item.get())) if self.item.exists() else None
        changes, seen, new = {}, set(), []
        if held is not None and held["version"]:  # an item of version 0 had no edit
            changes = {c[0]: tuple(c[1:]) for c in self.changes.get()}
            seen = {e for (some,) in self.seen.get() for e in some}
        for edit in edits:
            outcome = _outcome(held, edit, changes, seen, new)
            if outcome == "applied":
                _apply(held, edit)
            yield _HISTORY(*key, edit["edit_id"], outcome, *(held.values() if held else _NOTHING))
        if new:
            self.item.update(tuple(held[c] for c in _STATE))
            self.changes.put([(place, *last) for place, last in changes.items()])
            self.seen.appendList([(new[k : k + _IDS],) for k in range(0, len(new), _IDS)])

    def close(self) -> None:
        pass


_STATE = [c.split()[0] for c in STATE_DDL.split(", ")]
_FIELDS = ("status", "reasons", "comment", "tag+", "tag-")
_HISTORY = Row(*KEYS, "edit_id", "outcome", *_STATE)
_NOTHING = (None,) * len(_STATE)
#: Names of edits in one value of the state.
_IDS = 1000


def _outcome(held: dict | None, edit: dict, changes: dict[str, tuple], seen: set[str], new: list[str]) -> str:
    """What becomes of an edit; changes (place to version, reviewer, value) and the names in seen and new follow."""
    if held is None:
        return "no item"
    if edit["field"] not in _FIELDS:
        return "no field"
    this = edit["edit_id"] or ""
    if this in seen:
        return "repeated"
    place = f"tag {edit['value']}" if edit["field"].startswith("tag") else edit["field"]
    last = changes.get(place)
    value = edit["field"] if edit["field"].startswith("tag") else edit["value"] or ""
    # someone else changed the same thing, to something else, after what this editor saw
    clash = last is not None and last[0] > (edit["base"] or 0) and last[1] != (edit["reviewer"] or "") and last[2] != value
    seen.add(this)
    new.append(this)
    if not clash:
        changes[place] = (held["version"] + 1, edit["reviewer"] or "", value)
    return "conflict" if clash else "applied"


def _apply(held: dict, edit: Row) -> None:
    """Changes an item by an edit; the fields' copies among the tags follow."""
    field, value = edit["field"], edit["value"] or ""
    held["version"] += 1
    tags = list(held["tags"] or [])
    if field in ("tag+", "tag-"):
        tags = [t for t in tags if t != value] + ([value] if field == "tag+" else [])
    elif field == "status":
        tags = [t for t in tags if not t.startswith("review:")] + [f"review:{value}"]
    elif field == "reasons":
        tags = [t for t in tags if not t.startswith("reason:")] + [f"reason:{r}" for r in value.split("|") if r]
    if field in ("status", "reasons", "comment"):
        held[field] = value
        held["reviewer"], held["reviewed_at"] = edit["reviewer"] or "", edit["at"] or ""
    held["tags"] = tags


def edit_stream(items: DataFrame, incoming: str, history: str, checkpoint: str, files: int | None = None):
    """Applies JSON lines of edits (EDIT_DDL) from a folder to the items, once to each; returns the running query.

    items, of distinct keys, are where a new checkpoint starts; a query started again on the same checkpoint goes on
    from the state it held, and edits read before are not read twice. history gets a row for each edit, with the item
    after it: applied; conflict (not applied: another reviewer changed the same field, or the same tag, to another value
    after version `base`); repeated (its edit_id was seen for the item); no item; no field. Edits of an item in one batch
    are taken by time; those of one batch and item meet in one task, and `files` bounds a batch. The state is kept by
    RocksDB on the executors' disks, and in the checkpoint.
    """
    spark = items.sparkSession
    reader = spark.readStream.schema(EDIT_DDL)
    edits = (reader.option("maxFilesPerTrigger", files) if files else reader).json(incoming).select(*KEYS, *[c for c in ("edit_id", "at", "reviewer", "base", "field", "value")])
    start = items.select(*KEYS, *_STATE).groupBy(*KEYS)
    out = edits.groupBy(*KEYS).transformWithState(Edits(), HISTORY_DDL, "Append", "None", initialState=start)
    writer = out.writeStream.format("parquet").option("path", history).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return writer.start()  # a query keeps the settings that it starts with
    finally:
        spark.conf.set(provider, before)


def edited(items: DataFrame, history: DataFrame) -> DataFrame:
    """Items as their last applied edits left them."""
    last = history.filter("outcome = 'applied'").groupBy(*KEYS).agg(F.max_by(F.struct(*_STATE), "version").alias("_h"))
    j = items.join(last, KEYS, "left")
    return j.select(*[(F.when(F.col("_h").isNotNull(), F.col(f"_h.{c}")).otherwise(F.col(c)) if c in _STATE else F.col(c)).alias(c) for c in items.columns])
