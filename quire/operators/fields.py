"""From a field profile to the list of columns to promote, and the reports about it.

Inputs are profile rows (one per dataset and path), so everything here is small next to the records.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.values import round2
from quire.operators.ordered import BLOCK_ROWS, numbered

# Share of records that must hold a path for it to become a column, and the datasets that
# share one schema.
PRESENCE_THRESHOLD = 0.20
AAC_PRESENCE_THRESHOLD = 0.20
AAC_PREFIX = "aac_"
AUXILIARY_DATASETS = ("metadata", "journals", "digital_lending")
COMBINED = "*"  # the dataset under which a registry holds the names of combined fields


def threshold_for(dataset: Column | str = "dataset", threshold: float = PRESENCE_THRESHOLD,
                  aac_threshold: float = AAC_PRESENCE_THRESHOLD) -> Column:
    """Presence threshold by dataset kind, as a decimal so that 7 of 35 records are exactly 20 %."""
    dataset = F.col(dataset) if isinstance(dataset, str) else dataset
    plain, aac = (F.lit(Decimal(str(t))).cast("decimal(12,10)") for t in (threshold, aac_threshold))
    return F.when(dataset.startswith(AAC_PREFIX), aac).otherwise(plain)


def column_name(path: Column | str = "path") -> Column:
    """Path text to column name: ``.``, ``[`` and ``]`` become ``_``."""
    return F.translate(F.col(path) if isinstance(path, str) else path, ".[]", "___")


def with_column_names(fields: DataFrame, within: Sequence[str] = (), known: DataFrame | None = None) -> DataFrame:
    """Add ``column``; names that differ at most in case get ``__2``, ``__3`` in path order.

    A name that already ends like that is numbered always (``x__2`` becomes ``x__2__1``), so that no numbered name
    meets a natural one: without its last number every name tells the name it came from.

    ``known`` (``within`` columns, ``path``, ``column``) are names dealt earlier, which hold: a path has the name it had,
    whatever else is found now, and new paths are numbered on from the largest number dealt, also of paths gone since.
    """
    named = fields.withColumn("__name", column_name())
    ends = F.col("__name").rlike("__[0-9]+$")
    if known is None:
        same = Window.partitionBy(*within, F.lower("__name")).orderBy("path")
        number = F.row_number().over(same)
    else:
        dealt = known.select(*[F.col(w).alias(f"__w{i}") for i, w in enumerate(within)], F.col("path").alias("__path"),
                             F.col("column").alias("__column"), F.lower(column_name("path")).alias("__base")).distinct()
        keys = [f"__w{i}" for i in range(len(within))]
        last = F.when(F.lower("__column") == F.col("__base"), F.lit(1)).otherwise(
            F.regexp_extract("__column", "__([0-9]+)$", 1).cast("int"))
        most = dealt.groupBy(*keys, "__base").agg(F.max(last).alias("__most"))
        alike = lambda df, on: [F.col(w).eqNullSafe(df[k]) for w, k in zip(within, keys)] + on
        paths = dealt.select(*keys, "__path", "__column")
        named = named.join(paths, alike(paths, [F.col("path") == paths["__path"]]), "left").drop(*keys, "__path")
        named = named.join(most, alike(most, [F.lower("__name") == most["__base"]]), "left").drop(*keys, "__base")
        new = F.col("__column").isNull()
        same = Window.partitionBy(*within, F.lower("__name"), new).orderBy("path")
        number = F.coalesce(F.col("__most"), F.lit(0)) + F.row_number().over(same)
    fresh = F.when((number == 1) & ~ends, F.col("__name")).otherwise(F.concat("__name", F.lit("__"), number.cast("string")))
    if known is None:
        return named.withColumn("column", fresh).drop("__name")
    return named.withColumn("column", F.coalesce("__column", fresh)).drop("__name", "__column", "__most")


def _depth() -> Column:
    """Steps of a pointer."""
    return F.length("pointer") - F.length(F.replace("pointer", F.lit("/"), F.lit("")))


def select_fields(profile: DataFrame, threshold: float = PRESENCE_THRESHOLD,
                  aac_threshold: float = AAC_PRESENCE_THRESHOLD, known: DataFrame | None = None) -> DataFrame:
    """Paths held by at least the threshold share of a dataset's records, with their column names.

    The comparison includes equality and uses the counts as sampled, free of scaling and rounding. When two
    pointers share one path text (a key holding a dot), the more deeply nested one stands for it. ``known`` are names
    of earlier runs (:func:`column_registry`).
    """
    least = threshold_for("dataset", threshold, aac_threshold)
    enough = F.col("sampled_n") >= F.col("sampled_total") * least
    if "share" in profile.columns:  # weighted: sums of doubles, so a share right at the threshold may be a hair below it
        enough = F.col("share") >= least.cast("double") - 1e-12
    common = profile.filter((F.col("sampled_total") > 0) & enough)
    first = Window.partitionBy("dataset", "path").orderBy(_depth().desc(), F.col("pointer"))
    unique = common.withColumn("__k", F.row_number().over(first)).filter(F.col("__k") == 1).drop("__k")
    named = with_column_names(unique, ("dataset",), None if known is None else known.filter(F.col("dataset") != COMBINED))
    return named.select(
        "dataset", "path", "column", "pointer", "n_records", "total_records",
        _share(profile).alias("presence"),
    )


def in_group(group: str, dataset: Column | str = "dataset") -> Column:
    """Does a dataset belong to a group whose field lists are combined?"""
    dataset = F.col(dataset) if isinstance(dataset, str) else dataset
    if group == "elasticsearchaux":
        return dataset.isin(*AUXILIARY_DATASETS)
    if group == "aac":
        return dataset.startswith(AAC_PREFIX)
    return F.lit(False)


def combined_fields(selected: DataFrame, group: str, known: DataFrame | None = None) -> DataFrame:
    """Union of the selected fields over a group: ``path, pointer, datasets, column``.

    Where datasets reach one path text by different pointers, the deepest stands for the group, as in
    :func:`select_fields`; each dataset is still read by its own (:func:`fields_per_dataset`).
    """
    members = selected.filter(in_group(group))
    union = members.groupBy("path").agg(
        F.min_by("pointer", F.struct(-_depth(), "pointer")).alias("pointer"),
        F.array_sort(F.collect_set("dataset")).alias("datasets"),
    )
    return with_column_names(union, (), None if known is None else known.filter(F.col("dataset") == COMBINED))


def column_registry(selected: DataFrame, group: str, known: DataFrame | None = None) -> DataFrame:
    """Every name dealt so far: ``dataset, path, column``; those of a group's combined fields stand under ``*``.

    Its rows are the paths that some run selected, so it grows with the columns, never with the records.
    """
    own = selected.select("dataset", "path", "column")
    shared = combined_fields(selected, group, known).select(F.lit(COMBINED).alias("dataset"), "path", "column")
    now = own.unionByName(shared)
    return now if known is None else now.unionByName(known.select("dataset", "path", "column")).distinct()


def fields_per_dataset(selected: DataFrame, group: str, known: DataFrame | None = None) -> DataFrame:
    """X03. The columns each dataset is shredded into: ``dataset, path, column, pointer``.

    The auxiliary datasets all get the union of their fields, so that they share one schema (a path a dataset
    lacks is NULL there); every other dataset gets its own.
    """
    own = selected.select("dataset", "path", "column", "pointer")
    if group != "elasticsearchaux":
        return own
    members = F.array(*[F.lit(d) for d in AUXILIARY_DATASETS])
    union = combined_fields(selected, group, known).select(
        F.explode(members).alias("dataset"), "path", "column", F.col("pointer").alias("shared")
    )
    theirs = own.filter(in_group(group)).select("dataset", "path", "pointer")
    union = union.join(theirs, ["dataset", "path"], "left").select(
        "dataset", "path", "column", F.coalesce("pointer", "shared").alias("pointer")
    )
    return own.filter(~in_group(group)).unionByName(union)


def shared_fields(selected: DataFrame, profile: DataFrame, group: str) -> DataFrame:
    """Paths selected in every dataset of a group that has records; none when fewer than two have."""
    active = profile.filter(in_group(group) & (F.col("total_records") > 0)).select("dataset").distinct()
    n_active = active.agg(F.count(F.lit(1))).scalar()
    held = selected.filter(in_group(group)).groupBy("path").agg(F.count_distinct("dataset").alias("n_datasets"))
    return held.filter((F.col("n_datasets") == n_active) & (F.col("n_datasets") > 1)).select("path")


def selected_report(selected: DataFrame) -> DataFrame:
    """Selected fields with their presence in percent."""
    return selected.select(
        "dataset", "path", "column", round2(F.col("presence") * 100).alias("presence_pct")
    ).orderBy("dataset", "path")


def presence_report(profile: DataFrame) -> DataFrame:
    """Every field by descending presence, with the count behind the percentage."""
    return _presence(profile).orderBy("dataset", F.col("n_records").desc(), "path")


def _share(profile: DataFrame) -> Column:
    """Share of records that hold a path."""
    return F.col("share") if "share" in profile.columns else F.col("sampled_n") / F.col("sampled_total")


def _presence(profile: DataFrame) -> DataFrame:
    return profile.select("dataset", "path", round2(_share(profile) * 100).alias("presence_pct"), "n_records", "total_records")


def combined_report(combined: DataFrame) -> DataFrame:
    """Combined fields, those in most datasets first."""
    return combined.select(F.size("datasets").alias("n_datasets"), "path", "column", "datasets").orderBy(
        F.col("n_datasets").desc(), "path"
    )


def dropped_keys(profile: DataFrame, roots: Sequence[str], fixed: Sequence[str]) -> DataFrame:
    """Fields that shredding leaves out: top-level keys that are not fixed columns, and paths under other
    roots than ``roots``."""
    root = F.element_at(F.split(F.expr("substr(pointer, 2)"), "/"), 1)
    top = F.instr(F.expr("substr(pointer, 2)"), "/") == 0
    return profile.filter((top & ~F.col("path").isin(*fixed)) | (~top & ~root.isin(*roots))).select(
        "dataset", "path", "n_records"
    )


def field_report(profile: DataFrame, selected: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """S14. The two lists of a dataset's report, numbered: ``dataset, section, position, path, column, presence_pct,
    n_records, total_records``.

    Section ``selected`` holds the promoted fields by path, section ``all`` every path by falling count. Records that
    use ids as keys have as many paths as records, so the numbers come from blocks of rows, not from a window over a
    dataset.
    """
    columns = ["path", "column", "presence_pct", "n_records", "total_records"]
    chosen = selected.select("dataset", F.lit("selected").alias("section"), "path", "column",
                             round2(F.col("presence") * 100).alias("presence_pct"), "n_records", "total_records")
    every = _presence(profile).select("dataset", F.lit("all").alias("section"), "path",
                                            F.lit(None).cast("string").alias("column"), *columns[2:])
    falling = F.when(F.col("section") == "all", -F.col("n_records")).otherwise(F.lit(0))
    ordered = numbered(chosen.unionByName(every), ["dataset", "section"], [falling.asc(), F.col("path").asc()],
                       block_rows=block_rows)
    return ordered.select("dataset", "section", "position", *columns)


def report_line() -> Column:
    """A row of :func:`field_report` as one line of tab-separated text; paths hold no line breaks or tabs unescaped."""
    plain = F.translate(F.col("path"), "\t\n\r", "   ")
    return F.concat_ws("\t", "section", F.col("position").cast("string"), F.format_string("%.2f", "presence_pct"),
                       F.col("n_records").cast("string"), F.col("total_records").cast("string"), plain,
                       F.coalesce(F.translate("column", "\t\n\r", "   "), F.lit("")))


def selection_document(profile: DataFrame, selected: DataFrame, group: str, method: str,
                       threshold: float = PRESENCE_THRESHOLD,
                       aac_threshold: float = AAC_PRESENCE_THRESHOLD, known: DataFrame | None = None) -> DataFrame:
    """The selection as one JSON document (column ``value``), readable without profiling again.

    It holds selected paths only, and the names of all earlier runs, which ``known`` hands on. Since a selected path is in at least the threshold share of records, their
    number is at most (mean paths per record) / threshold per dataset.
    """
    field = F.struct(F.col("path").alias("field"), "column", "pointer")
    per_dataset = selected.groupBy("dataset").agg(F.array_sort(F.collect_list(field)).alias("fields"))
    chosen = per_dataset.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dataset", "fields"))))
                             .alias("common_fields"))
    totals = profile.groupBy("dataset").agg(F.max("total_records").alias("n"))
    counts = totals.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dataset", "n"))))
                        .alias("record_counts"))
    combined = combined_fields(selected, group, known).agg(
        F.array_sort(F.collect_list(F.struct(F.col("path").alias("field"), "column", "pointer", "datasets")))
        .alias("combined")
    )
    shared = shared_fields(selected, profile, group).agg(
        F.transform(F.array_sort(F.collect_list("path")), lambda p: F.struct(p.alias("field"))).alias("shared")
    )
    names = column_registry(selected, group, known).agg(
        F.array_sort(F.collect_list(F.struct("dataset", F.col("path").alias("field"), "column"))).alias("names"))
    parts = [
        chosen.select("common_fields").scalar().alias("common_fields"),
        counts.select("record_counts").scalar().alias("record_counts"),
        F.lit(method).alias("analysis_method"),
        F.struct(F.lit(threshold).alias("elasticsearch"), F.lit(aac_threshold).alias("aac"))
        .alias("field_presence_threshold"),
        combined.scalar().alias(f"combined_{group}_fields"),
        shared.scalar().alias(f"{group}_common_fields"),
        names.scalar().alias("column_names"),
    ]
    one = profile.sparkSession.range(1)
    return one.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("value"))
