"""Filters, projections and accessors of repeat and feature tables, as DataFrame steps and column expressions."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Internal marks in the names of ERV parts, and how names of the form ``fam.class`` come apart (fixed values).
INTERNAL = (r"[-_][iI]nt", r"[-_]I$")
DOTTED_FAMILY, DOTTED_CLASS = r"^(.*)\..*$", r"^.*\.(.*)$"


def internal_mark(fam: Column, name: str | Column = "rname") -> Column:
    """The family with --int for ERV parts whose name has an internal mark (-int or _int, -I or _I at its end)."""
    col = F.col(name) if isinstance(name, str) else name
    return F.when(fam.contains("ERV") & (col.rlike(INTERNAL[0]) | col.rlike(INTERNAL[1])), F.concat(fam, F.lit("--int"))).otherwise(fam)


def split_class_family(df: DataFrame, col: str = "classfam", internal: bool = True) -> DataFrame:
    """rclass and rfam of ``class/fam[/extra]`` (extra joined by _), else of ``fam.class``; without either both are the whole name.

    With ``internal``, ERV parts whose name has an internal mark get --int on the family.
    """
    p = F.split(F.col(col), "/")
    extra = F.coalesce(F.try_element_at(p, F.lit(3)), F.lit(""))
    slash = F.size(p) > 1
    fam = F.when(slash, F.concat(p[1], F.when(extra.isin("", "0"), "").otherwise(F.concat(F.lit("_"), extra)))).otherwise(F.regexp_replace(F.col(col), DOTTED_FAMILY, "$1"))
    cls = F.when(slash, p[0]).otherwise(F.regexp_replace(F.col(col), DOTTED_CLASS, "$1"))
    if internal and "rname" in df.columns:
        fam = internal_mark(fam)
    return df.withColumns({"rclass": cls, "rfam": fam})


#: What the classes left out contain, by filter mode (fixed values).
NON_TE = {
    "all": "",
    "no_low": "[Ll]ow_complexity|[Ss]imple_repeat",
    "no_nonTE": "nonTE",
    "none": "nonTE|snRNA|rRNA|tRNA|snoRNA|scRNA|srpRNA|[Ll]ow_complexity|[Ss]imple_repeat|[Ss]atellite|ARTEFACT",
}


def filter_nonte(df: DataFrame, mode: str = "none", col: str = "rclass") -> DataFrame:
    """Leave classes out by mode: none keeps transposable elements only, no_nonTE and no_low leave out the class named, all keeps everything."""
    rule = NON_TE[mode]
    return df.where(~F.coalesce(F.col(col), F.lit("")).rlike(rule)) if rule else df


def filter_repeat(df: DataFrame, kind: str, value: str, contains: bool = False, ignore_case: bool = False) -> DataFrame:
    """Keep one name, class or family, exactly or where it is contained."""
    c, v = F.col({"name": "rname", "class": "rclass", "family": "rfam"}[kind]), value
    if ignore_case:
        c, v = F.lower(c), v.lower()
    return df.where(c.contains(v) if contains else c == v)


def one_per_name(info: DataFrame, *cols: Column) -> DataFrame:
    """A row per lower-case rname (_l) with ``cols``: of repeated names the last by file and place if ``info`` has them, else the greatest values."""
    names = [F.lower("rname").alias("_l"), F.struct(*cols).alias("_v")]
    if {"file", "place"} <= set(info.columns):
        return info.select(*names, F.struct("file", "place").alias("_o")).groupBy("_l").agg(F.max_by("_v", "_o").alias("_v")).select("_l", "_v.*")
    return info.select(*names).groupBy("_l").agg(F.max("_v").alias("_v")).select("_l", "_v.*")


def override_class(te: DataFrame, te_info: DataFrame | None = None, rm_info: DataFrame | None = None) -> DataFrame:
    """Class and family from the TE table, else the parsed table, else the row's own; matched on lower-case names."""
    out = te.withColumn("_l", F.lower("rname"))
    for k, info in enumerate(x for x in (te_info, rm_info) if x is not None):
        i = one_per_name(info, F.col("rclass").alias(f"_c{k}"), F.col("rfam").alias(f"_f{k}"))
        out = out.join(i, "_l", "left")
    cs, fs = [c for c in out.columns if c.startswith("_c")], [c for c in out.columns if c.startswith("_f")]
    return out.withColumns({"rclass": F.coalesce(*cs, "rclass"), "rfam": F.coalesce(*fs, "rfam")}).drop("_l", *cs, *fs)


def filter_input(df: DataFrame, col: str, value: str) -> DataFrame:
    """Keep rows whose column, or attribute of that key, has the value (any of a list's)."""
    if col in df.columns:
        return df.where(F.col(col) == value)
    kind = dict(df.dtypes)["attributes"]
    v = F.element_at("attributes", col)
    return df.where(F.array_contains(v, value) if "array" in kind else v == value)


def keep_known_seq(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Drop rows on sequences that the size table lacks."""
    return df.join(sizes.select("chrom").distinct(), "chrom", "left_semi")


def contig_alias(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rename unplaced contigs (GL...) to the size table's name that ends or goes on with their number."""
    s = sizes.select(F.lower(F.regexp_extract("chrom", r"(?i)(gl\d+)", 1)).alias("_gl"), F.col("chrom").alias("_known")).where("_gl <> ''").dropDuplicates(["_gl"])
    own = F.lower(F.regexp_extract("chrom", r"(?i)(gl\d+)", 1))
    return df.withColumn("_gl", own).join(s, "_gl", "left").withColumn("chrom", F.coalesce("_known", "chrom")).drop("_gl", "_known")


_COMPARE = {"==": operator.eq, "eq": operator.eq, "!=": operator.ne, "ne": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def search(df: DataFrame, where: dict[str, object], order_by: Sequence[str] = ()) -> DataFrame:
    """Rows that meet all conditions: a value, a list (any of them), or {operator: value}."""
    conds = []
    for c, v in where.items():
        if isinstance(v, dict):
            conds += [_COMPARE[op](F.col(c), x) for op, x in v.items()]
        elif isinstance(v, (list, tuple, set)):
            conds.append(F.col(c).isin(list(v)))
        else:
            conds.append(F.col(c) == v)
    out = df.where(functools.reduce(operator.and_, conds)) if conds else df
    return out.orderBy(*order_by) if order_by else out


def locus(chrom: str = "chrom", start: str = "start", end: str = "end") -> Column:
    return F.concat(F.col(chrom), F.lit(":"), F.col(start).cast("string"), F.lit("-"), F.col(end).cast("string"))


def as_map(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])


def my_start() -> Column:
    """The 5' coordinate on the feature's strand."""
    return F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))


def my_end() -> Column:
    return F.when(F.col("strand") == "-", F.col("start")).otherwise(F.col("end"))


def genomic_length() -> Column:
    return F.col("end") - F.col("start") + 1


def attribute(key: str) -> Column:
    """The list of an attribute's values, null if the feature lacks it."""
    return F.try_element_at(F.col("attributes"), F.lit(key))


def attributes_long(df: DataFrame, id_col: str = "feature_id") -> DataFrame:
    """One row per feature, key and value."""
    return df.select(id_col, F.explode("attributes").alias("att_key", "vs")).select(id_col, "att_key", F.explode("vs").alias("att_value"))


#: Bin sizes of a feature, smallest first (fixed values).
BIN_SIZES = (128_000, 1_000_000, 8_000_000, 64_000_000, 512_000_000)


def smallest_bin() -> Column:
    """``seqid:level:bin`` of the smallest bin that holds the whole feature; level 1 is the smallest size."""
    at = [F.when(F.floor(F.col("start") / s) == F.floor(F.col("end") / s), F.concat_ws(":", "chrom", F.lit(str(k + 1)), F.floor(F.col("start") / s).cast("string"))) for k, s in enumerate(BIN_SIZES)]
    return F.coalesce(*at)


def all_bins() -> Column:
    """All bins of all sizes that a feature touches."""
    per = [F.transform(F.sequence(F.floor(F.col("start") / s), F.floor(F.col("end") / s)), (lambda k: lambda b: F.concat_ws(":", F.col("chrom"), F.lit(str(k + 1)), b.cast("string")))(k)) for k, s in enumerate(BIN_SIZES)]
    return F.concat(*per)


def add_age(df: DataFrame, te_info: DataFrame, rm_info: DataFrame | None = None) -> DataFrame:
    """Add lineage, age and pct_div of each repeat; the divergence falls back to the parsed table's."""
    i = one_per_name(te_info, F.col("lineage"), F.col("age"), F.col("pct_div").alias("_d1"))
    out = df.withColumn("_l", F.lower("rname")).join(i, "_l", "left")
    if rm_info is not None:
        out = out.join(one_per_name(rm_info, F.col("pct_div").alias("_d2")), "_l", "left")
    return out.withColumn("pct_div", F.coalesce(*[c for c in ("_d1", "_d2") if c in out.columns])).drop("_l", "_d1", "_d2")


def variant_view(df: DataFrame) -> DataFrame:
    """Variant accessors: sequences, the reference, alleles without it, reads, genotype, copy number."""
    one = lambda k: F.try_element_at(attribute(k), F.lit(1))
    seqs, ref = attribute("Variant_seq"), one("Reference_seq")
    return df.withColumns(
        {
            "variant_seq": seqs,
            "reference_seq": ref,
            "variant_seq_no_ref": F.array_distinct(F.filter(seqs, lambda x: ~x.eqNullSafe(ref))),
            "variant_reads": attribute("Variant_reads"),
            "total_reads": one("Total_reads").cast("long"),
            "genotype": F.coalesce(one("Genotype"), F.when(F.size(F.array_distinct(seqs)) > 1, "heterozygous").otherwise("homozygous")),
            "copy_number": one("Variant_copy_number").cast("double"),
        }
    )
