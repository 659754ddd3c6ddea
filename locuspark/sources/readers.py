"""Readers: annotation, interval, variant and sequence formats to typed DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuspark.functions.features import internal_mark, split_class_family
from locuspark.functions.sequences import expand_iupac
from locuspark.storage import if_small

#: Metadata and comment lines.
COMMENT = r"^\s*(#|$)"


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, file): text lines with their file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, file, place): text lines with their place in the file, the offset of the split and a number that grows within it."""
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))


def skip_records(df: DataFrame, comment: str = COMMENT, metadata: str | None = None) -> DataFrame:
    """Drop comment, blank and metadata lines."""
    out = df.where(~F.col("value").rlike(comment))
    return out.where(~F.col("value").rlike(metadata)) if metadata else out


def read_records(
    spark: SparkSession, path: str | Sequence[str], comment: str = r"^\s*#", metadata: str | None = None, header_count: int = 0, end_of_data: str | None = None
) -> DataFrame:
    """(value, file): the records of text files of any size, split anywhere.

    From the first line that matches ``end_of_data`` on a file gives nothing, whatever the line is. Blank, metadata
    and comment lines go; of the lines that are left, the first ``header_count`` of each file are headers and go too.
    """
    rows = placed_lines(spark, path)
    if end_of_data is not None:
        stop = rows.where(F.col("value").rlike(end_of_data)).groupBy("file").agg(F.min("place").alias("_stop"))  # a row per file
        rows = rows.join(if_small(stop, stop.count(), 100_000), "file", "left").where(F.col("_stop").isNull() | (F.col("place") < F.col("_stop"))).drop("_stop")
    rows = skip_records(rows.where(F.trim("value") != ""), comment, metadata)
    if header_count:
        first = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("place"))).where(F.col("_r") <= header_count).drop("_r")
        heads = first(first(rows.select("file", "place"), "file", "place.split"), "file")  # a split hands on as many lines at most
        rows = rows.join(if_small(heads, heads.count(), 100_000), ["file", "place"], "left_anti")
    return rows.select("value", "file")


def header_lines(df: DataFrame, pattern: str, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hand the comment or metadata lines to a user's function of a DataFrame."""
    return parse(df.where(F.col("value").rlike(pattern)))


def read_rmsk(spark: SparkSession, path: str | Sequence[str], base: int = 1) -> DataFrame:
    """RepeatMasker output: one row per repeat, start raised by one for zero-based files.

    Header and blank lines go; a trailing * is dropped; C strands become -; class and family are split.
    """
    v = F.regexp_replace(F.trim("value"), r"\s*\*$", "")
    p = F.split(v, r"\s+")
    rows = lines(spark, path).where(F.col("value").rlike(r"^\s*[0-9]")).withColumn("p", p)
    n = lambda i, kind="long": F.try_element_at("p", F.lit(i + 1)).try_cast(kind)
    s = lambda i: F.try_element_at("p", F.lit(i + 1))
    t = rows.select(
        n(0).alias("score"), n(1, "double").alias("div"), n(2, "double").alias("del"), n(3, "double").alias("ins"), s(4).alias("chrom"), (n(5) + (1 if base == 0 else 0)).alias("start"), n(6).alias("end"),
        F.when(s(8) == "C", "-").otherwise(s(8)).alias("strand"), s(9).alias("rname"), s(10).alias("classfam"), s(11).alias("r11"), s(12).alias("r12"), s(13).alias("r13"), s(14).alias("block"),
    )
    return split_class_family(t).drop("classfam")


def read_te_bed(spark: SparkSession, path: str) -> DataFrame:
    """Repeat BED whose fourth column packs the fifteen annotation fields with semicolons."""
    c = spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, packed string, dot string, strand string", comment="#")
    p = F.split("packed", ";")
    t = c.select("chrom", "start", "end", p[0].cast("long").alias("score"), p[1].cast("double").alias("div"), p[9].alias("rname"), p[10].alias("classfam"), p[11].alias("r11"), p[12].alias("r12"), p[13].alias("r13"), p[14].alias("block"), F.when(F.col("strand") == "C", "-").otherwise(F.col("strand")).alias("strand"))
    return split_class_family(t).drop("classfam")


_BED = ("chrom", "start", "end", "name", "score", "strand", "thickStart", "thickEnd", "itemRgb", "blockCount", "blockSizes", "blockStarts")


def read_bed(spark: SparkSession, path: str | Sequence[str], one_based: bool = True) -> DataFrame:
    """BED of 3 to 12 columns; starts are raised by one unless the file is one-based already. Adds feature_key."""
    rows = skip_records(lines(spark, path), metadata=r"^(track|browser)\b").withColumn("p", F.split("value", r"\t"))
    col = lambda i: F.try_element_at("p", F.lit(i + 1))
    numbers = {"start", "end", "thickStart", "thickEnd", "blockCount"}
    t = rows.select(*[(col(i).cast("long") if c in numbers else col(i)).alias(c) for i, c in enumerate(_BED)])
    t = t if one_based else t.withColumn("start", F.col("start") + 1)
    t = t.withColumn("strand", F.coalesce("strand", F.lit(".")))
    return t.withColumn("feature_key", F.concat_ws("#", "name", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand"))


def _attributes(col: str) -> Column:
    """Attribute map of column nine: key "v", key=v or key v; *_biotype is named *_type."""
    parts = F.filter(F.transform(F.split(col, r"\s*;\s*"), F.trim), lambda x: x != "")
    kv = F.transform(parts, lambda x: F.struct(F.regexp_replace(F.regexp_extract(x, r"^([^\s=]+)", 1), "_biotype$", "_type").alias("k"), F.trim(F.regexp_replace(F.regexp_replace(x, r"^[^\s=]+[\s=]*", ""), '"', "")).alias("v")))
    first = F.aggregate(kv, F.array().cast("array<struct<k:string,v:string>>"), lambda acc, e: F.when(F.exists(acc, lambda y: y["k"] == e["k"]), acc).otherwise(F.concat(acc, F.array(e))))
    return F.map_from_entries(first)


def read_gtf(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """GTF or GFF lines with an attribute map; chr is put before bare chromosome names, strands 1 and -1 become + and -, MT is left out."""
    p = F.split("value", r"\t")
    rows = skip_records(lines(spark, path)).select(p.alias("p"))
    chrom = F.when(F.col("p")[0].rlike(r"^([0-9]+|[A-Z])$"), F.concat(F.lit("chr"), F.col("p")[0])).otherwise(F.col("p")[0])
    strand = F.when(F.col("p")[6] == "1", "+").when(F.col("p")[6] == "-1", "-").otherwise(F.col("p")[6])
    t = rows.where(~F.col("p")[0].rlike("^MT")).select(chrom.alias("chrom"), F.col("p")[1].alias("source"), F.col("p")[2].alias("type"), F.col("p")[3].cast("long").alias("start"), F.col("p")[4].cast("long").alias("end"), F.col("p")[5].alias("score"), strand.alias("strand"), F.col("p")[7].alias("phase"), F.col("p")[8].alias("_a"))
    return t.withColumn("attributes", _attributes("_a")).drop("_a")


def list_attributes(col: str) -> Column:
    """Multi-valued attributes of GFF3: key=v1,v2; values of a repeated key come together."""
    parts = F.filter(F.split(F.trim(F.col(col)), r"\s*;\s*"), lambda x: x.contains("="))
    kv = F.transform(parts, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.split(F.regexp_replace(x, "^[^=]*=", ""), ",").alias("v")))
    keys = F.array_distinct(F.transform(kv, lambda e: e["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.flatten(F.transform(F.filter(kv, lambda e: e["k"] == k), lambda e: e["v"])))))


_GFF = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 lines as features; a feature without ID gets type_digest of its whole line.

    Lines are told apart one by one, so files of any size are split: a feature has nine columns;
    sequences after ##FASTA have none of them, and their headers begin with >.
    """
    rows = spark.read.text(path).where(~F.col("value").rlike(COMMENT + "|^>")).select(F.split("value", r"\t").alias("p"), "value").where(F.size("p") >= 9)
    t = rows.select(*[(F.col("p")[i].cast("long") if c in ("start", "end") else F.col("p")[i]).alias(c) for i, c in enumerate(_GFF[:8])], F.col("p")[8].alias("_a"), "value")
    t = t.withColumn("attributes", list_attributes("_a"))
    own = F.try_element_at(F.try_element_at(F.col("attributes"), F.lit("ID")), F.lit(1))
    t = t.withColumn("feature_id", F.coalesce(own, F.concat_ws("_", "type", F.lower(F.hex(F.xxhash64("value"))))))
    with_id = F.when(own.isNull(), F.map_concat(F.map_filter("attributes", lambda k, v: k != "ID"), F.create_map(F.lit("ID"), F.array("feature_id")))).otherwise(F.col("attributes"))
    return t.withColumn("attributes", with_id).select("feature_id", *_GFF)


def read_mapped(spark: SparkSession, path: str, colmap: dict[str, int], add_cols: Sequence[int] = (), sep: str = "\t") -> DataFrame:
    """Any delimited file by a map of names to column numbers (from 1); added columns pass through as added_n."""
    p = F.split("value", sep)
    rows = skip_records(lines(spark, path)).select(p.alias("p"))
    num = {"start", "end"}
    at = lambda i: F.try_element_at("p", F.lit(i))
    return rows.select(*[(at(i).cast("long") if c in num else at(i)).alias(c) for c, i in colmap.items()], *[at(i).alias(f"added_{i}") for i in add_cols])


def parse_colmap(spark: SparkSession, path: str) -> dict[str, int]:
    """A column map file, ``name = number #comment`` per line (a few lines)."""
    rows = spark.read.text(path).where(F.col("value").rlike(r"^\s*\w+\s*=\s*\d+"))
    return {r[0]: int(r[1]) for r in rows.select(F.regexp_extract("value", r"^\s*(\w+)", 1), F.regexp_extract("value", r"=\s*(\d+)", 1)).collect()}


def read_te_info(spark: SparkSession, path: str | Sequence[str], per_file: bool = False) -> DataFrame:
    """Repeat table: rname, rclass, rfam, pct_div, lineage, age; of a lower-case name given more than once the last row.

    The first / in a family becomes _; internal ERV parts get --int on the family. Several files are one table, in the
    order of their names, or with ``per_file`` a table each, with the column file.
    """
    c = skip_records(placed_lines(spark, path), COMMENT + "|^(?i:rname)").withColumn("p", F.split("value", r"\t"))
    at = lambda i: F.try_element_at("p", F.lit(i))
    t = c.select(at(1).alias("rname"), at(2).alias("rclass"), internal_mark(F.concat_ws("_", F.substring_index(at(3), "/", 1), F.when(F.instr(at(3), "/") > 0, F.regexp_replace(at(3), "^[^/]*/", ""))), at(1)).alias("rfam"), at(5).try_cast("double").alias("pct_div"), at(6).alias("lineage"), at(7).alias("age"), "file", "place")
    by = [*(["file"] if per_file else []), F.lower("rname").alias("rname_lc")]
    last = t.groupBy(*by).agg(F.max_by(F.struct("rname", "rclass", "rfam", "pct_div", "lineage", "age"), F.struct("file", "place")).alias("_t"))
    return last.select("_t.*", "rname_lc", *by[:-1])


#: Column numbers (from 0) of a parsed summary table by layout (fixed values); the older one has one more column before them if its header names Rlen.
PARSED_RM = {
    "new": {"count": 4, "nr_count": 5, "len": 6, "pct": 14, "len_overlap": 15, "pct_overlap": 16},
    "old": {"count": 5, "nr_count": 7, "len": 14, "pct": 17, "len_overlap": 18, "pct_overlap": 19},
}


def read_parsed_rm(spark: SparkSession, path: str) -> DataFrame:
    """Genome totals per repeat of a summary table, either layout: rname_lc, rclass, rfam, g_len, g_pct, g_count, g_nr.

    A header with Rfullname and MED_LEN_MASKED means the old layout. Overlaps (length and
    percent, where both are given) are taken off; several rows of one lower-case name add
    up. A table whose percentages are nd was made without a genome size: an error.
    """
    rows = skip_records(lines(spark, path), COMMENT + "|^Rname").withColumn("p", F.split("value", r"\t"))
    heads = spark.read.text(path).where(F.col("value").rlike("Rfullname")).agg(F.max(F.col("value").contains("MED_LEN_MASKED")).alias("old"), F.max(F.col("value").contains("Rlen")).alias("rlen")).first()
    at, shift = PARSED_RM["old" if heads["old"] else "new"], int(bool(heads["old"] and heads["rlen"]))
    text = lambda k: F.try_element_at("p", F.lit(at[k] + shift + 1))
    num = lambda k: text(k).try_cast("double")
    given = ~(F.coalesce(text("len_overlap"), F.lit("")).isin("", "0") | F.coalesce(text("pct_overlap"), F.lit("")).isin("", "0"))
    less = lambda a, b: num(a) - F.when(given, F.coalesce(num(b), F.lit(0.0))).otherwise(0.0)
    pct = F.when(text("pct") == "nd", F.raise_error(F.lit("the percent of the genome is missing (nd) in the parsed table"))).otherwise(less("pct", "pct_overlap")).cast("double")
    cell = lambda i: F.try_element_at("p", F.lit(i))
    fam = internal_mark(F.concat_ws("_", F.substring_index(cell(3), "/", 1), F.when(F.instr(cell(3), "/") > 0, F.regexp_replace(cell(3), "^[^/]*/", ""))), cell(1))
    t = rows.select(F.lower(cell(1)).alias("rname_lc"), cell(2).alias("rclass"), fam.alias("rfam"), less("len", "len_overlap").alias("l"), pct.alias("p"), num("count").alias("c"), num("nr_count").alias("n"))
    return t.groupBy("rname_lc").agg(F.max("rclass").alias("rclass"), F.max("rfam").alias("rfam"), F.sum("l").cast("long").alias("g_len"), F.sum("p").alias("g_pct"), F.sum("c").cast("long").alias("g_count"), F.sum("n").cast("long").alias("g_nr"))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    p = F.split(F.trim("value"), r"\s+")
    return skip_records(lines(spark, path)).select(p[0].alias("chrom"), p[1].cast("long").alias("length"))


def fasta_chunks(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    """(chrom, start, seq): the lines of FASTA sequences, each with its 1-based place; the name is the header's first word.

    With ``per_file`` the column file too.

    Files are split at any line. A line's sequence and place come from running sums inside its split
    and one carried row per split, so neither a sequence nor a file is ever one row.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))
    head = F.col("value").startswith(">")
    rows = rows.withColumns({"_head": head.cast("int"), "_seq": F.when(head, "").otherwise(F.regexp_replace("value", r"\s", ""))})
    upto = Window.partitionBy("_file", "_split").orderBy("_at")
    rows = rows.withColumns({"_no": F.sum("_head").over(upto), "_sum": F.sum(F.length("_seq")).over(upto) - F.length("_seq")})
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("_file", "_split").agg(F.sum("_head").alias("_h"), F.sum(F.length("_seq")).alias("_n"))
    carried = carried.select("_file", "_split", F.coalesce(F.sum("_h").over(earlier), F.lit(0)).alias("_h0"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"))
    rows = rows.join(carried, ["_file", "_split"]).withColumns({"_no": F.col("_no") + F.col("_h0"), "_sum": F.col("_sum") + F.col("_n0")})
    names = rows.where("_head = 1").select("_file", "_no", F.split(F.trim(F.substring("value", 2, 1 << 30)), r"\s+")[0].alias("chrom"), F.col("_sum").alias("_from"))
    lines_ = rows.where("_head = 0 AND _seq <> ''").join(names, ["_file", "_no"])
    return lines_.select("chrom", (F.col("_sum") - F.col("_from") + 1).cast("long").alias("start"), F.col("_seq").alias("seq"), *([F.col("_file").alias("file")] if per_file else []))


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, seq): whole sequences, for genes and other short ones; chromosomes are read as fasta_chunks."""
    parts = F.array_sort(F.collect_list(F.struct("start", "seq")))
    return fasta_chunks(spark, path).groupBy("chrom").agg(F.array_join(F.transform(parts, lambda x: x["seq"]), "").alias("seq"))


def fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    return fasta_chunks(spark, path).groupBy("chrom").agg(F.sum(F.length("seq")).cast("long").alias("length"))


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Gap table with bin, chrom, start, end first."""
    p = F.split("value", r"\t")
    return skip_records(lines(spark, path)).select(p[1].alias("chrom"), p[2].try_cast("long").alias("start"), p[3].try_cast("long").alias("end")).where("start IS NOT NULL")


def gaps_from_table(df: DataFrame, min_len: int = 50) -> DataFrame:
    return df.where(F.col("end") - F.col("start") >= min_len)


def concat_inputs(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def exon_intervals(gtf: DataFrame) -> DataFrame:
    """Exon lines as intervals named transcript#chrom:start-end; MT and empty ones left out."""
    e = gtf.where((F.col("type") == "exon") & ~F.col("chrom").rlike("MT") & (F.col("end") >= F.col("start")))
    name = F.concat(F.try_element_at(F.col("attributes"), F.lit("transcript_id")), F.lit("#"), F.col("chrom"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    return e.select("chrom", "start", "end", name.alias("name"), "strand")


def read_many(spark: SparkSession, pattern: str, reader: Callable[[SparkSession, str], DataFrame], name: str = r"([^/]+)$") -> DataFrame:
    """Every file that matches, in one scan, as one table with run taken from each file's path by ``name``.

    Readers that go line by line need nothing more; those that shuffle keep their rows' file with ``per_file``
    (``functools.partial(read_te_info, per_file=True)``), and it gives the run.
    """
    rows = reader(spark, pattern)
    file = F.col("file") if "file" in rows.columns else F.input_file_name()
    return rows.withColumn("run", F.regexp_extract(file, name, 1)).drop("file")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """VCF 4 lines as variants: alleles as a list, INFO as vcf_* lists, format and sample columns kept."""
    p = F.split("value", r"\t")
    rows = skip_records(lines(spark, path)).select(p.alias("p"))
    info = F.filter(F.split(F.col("p")[7], ";"), lambda x: x != "")
    kv = F.transform(info, lambda x: F.struct(F.concat(F.lit("vcf_"), F.substring_index(x, "=", 1)), F.when(x.contains("="), F.split(F.regexp_replace(x, "^[^=]*=", ""), ",")).otherwise(F.array(F.lit("")))))
    ref, alt = F.col("p")[3], F.split(F.col("p")[4], ",")
    longest, shortest = F.array_max(F.transform(alt, F.length)), F.array_min(F.transform(alt, F.length))
    kind = F.when((F.length(ref) == 1) & (longest == 1), "SNV").when(shortest > F.length(ref), "insertion").when(longest < F.length(ref), "deletion").otherwise("indel")
    start = F.col("p")[1].cast("long")
    return rows.select(
        F.when(F.col("p")[2] != ".", F.col("p")[2]).otherwise(F.concat_ws(":", F.col("p")[0], F.col("p")[1], ref)).alias("feature_id"), F.col("p")[0].alias("seqid"), kind.alias("type"), start.alias("start"), (start + F.length(ref) - 1).alias("end"),
        F.col("p")[5].alias("score"), F.lit("+").alias("strand"), ref.alias("reference_seq"), alt.alias("variant_seq"), F.col("p")[6].alias("filter"), F.map_from_entries(kv).alias("attributes"),
        F.try_element_at("p", F.lit(9)).alias("format"), F.slice("p", 10, F.size("p")).alias("samples"),
    )


#: Effect terms of the annotators by dialect (fixed values): annotator's word -> (ontology terms, feature type).
EFFECTS: dict[str, dict[str, tuple[str, str]]] = {
    "snpeff": {
        "INTERGENIC": ("intergenic_variant", "intergenic_region"),
        "UPSTREAM": ("upstream_gene_variant", "gene"),
        "DOWNSTREAM": ("downstream_gene_variant", "gene"),
        "UTR_5_PRIME": ("5_prime_UTR_variant", "five_prime_UTR"),
        "UTR_3_PRIME": ("3_prime_UTR_variant", "three_prime_UTR"),
        "START_GAINED": ("5_prime_UTR_premature_start_codon_gain_variant", "five_prime_UTR"),
        "SPLICE_SITE_ACCEPTOR": ("splice_acceptor_variant", "splice_acceptor"),
        "SPLICE_SITE_DONOR": ("splice_donor_variant", "splice_donor"),
        "START_LOST": ("start_lost", "mRNA"),
        "STOP_GAINED": ("stop_gained", "mRNA"),
        "STOP_LOST": ("stop_lost", "mRNA"),
        "CDS": ("coding_sequence_variant", "mRNA"),
        "GENE": ("gene_variant", "gene"),
        "TRANSCRIPT": ("transcript_variant", "transcript"),
        "EXON": ("exon_variant", "exon"),
        "INTRON": ("intron_variant", "intron"),
        "NON_SYNONYMOUS_CODING": ("missense_variant", "mRNA"),
        "SYNONYMOUS_CODING": ("synonymous_variant", "mRNA"),
        "FRAME_SHIFT": ("frameshift_variant", "mRNA"),
        "UTR_5_DELETED": ("5_prime_UTR_truncation", "five_prime_UTR"),
        "UTR_3_DELETED": ("3_prime_UTR_truncation", "three_prime_UTR"),
        "SYNONYMOUS_START": ("start_retained_variant", "mRNA"),
        "SYNONYMOUS_STOP": ("stop_retained_variant", "mRNA"),
        "EXON_DELETED": ("exon_loss_variant", "exon"),
        "CODON_CHANGE": ("coding_sequence_variant", "mRNA"),
        "CODON_INSERTION": ("inframe_insertion", "mRNA"),
        "CODON_CHANGE_PLUS_CODON_INSERTION": ("disruptive_inframe_insertion", "mRNA"),
        "CODON_DELETION": ("inframe_deletion", "mRNA"),
        "CODON_CHANGE_PLUS_CODON_DELETION": ("disruptive_inframe_deletion", "mRNA"),
        "INTRON_CONSERVED": ("conserved_intron_variant", "intron"),
        "INTERGENIC_CONSERVED": ("conserved_intergenic_variant", "intergenic_region"),
        "INTRAGENIC": ("intragenic_variant", "gene"),
    },
    "seattleseq": {
        "missense": ("missense_variant", "mRNA"),
        "coding-synonymous": ("synonymous_variant", "mRNA"),
        "intron": ("intron_variant", "transcript"),
        "utr-5": ("5_prime_UTR_variant", "five_prime_UTR"),
        "utr-3": ("3_prime_UTR_variant", "three_prime_UTR"),
        "intergenic": ("intergenic_variant", "intergenic_region"),
        "stop-gained": ("stop_gained", "mRNA"),
        "stop-lost": ("stop_lost", "mRNA"),
        "missense-near-splice": ("missense_variant splice_region_variant", "mRNA"),
        "stop-gained-near-splice": ("stop_gained splice_region_variant", "mRNA"),  # the reference says stop_lost
        "stop-lost-near-splice": ("stop_lost splice_region_variant", "mRNA"),
        "coding-synonymous-near-splice": ("synonymous_variant splice_region_variant", "mRNA"),
        "frameshift": ("frameshift_variant", "mRNA"),
        "frameshift-near-splice": ("frameshift_variant splice_region_variant", "mRNA"),
        "coding-notMod3": ("frameshift_variant", "mRNA"),
        "coding-notMod3-near-splice": ("frameshift_variant", "mRNA"),
        "codingComplex": ("coding_sequence_variant", "mRNA"),
        "codingComplex-near-splice": ("coding_sequence_variant splice_region_variant", "mRNA"),
        "coding": ("coding_sequence_variant", "mRNA"),
        "coding-near-splice": ("splice_region_variant", "mRNA"),
        "splice-5": ("splice_donor_variant", "mRNA"),
        "splice-3": ("splice_acceptor_variant", "mRNA"),
        "near-gene-5": ("2KB_upstream_variant", "gene"),
        "near-gene-3": ("500B_downstream_variant", "gene"),
    },
    "annovar": {
        "nonsynonymous SNV": ("missense_variant", "mRNA"),
        "synonymous SNV": ("synonymous_variant", "mRNA"),
        "stopgain SNV": ("stop_gained", "mRNA"),
        "stoploss SNV": ("stop_lost", "mRNA"),
        "frameshift insertion": ("frameshift_elongation", "mRNA"),
        "frameshift deletion": ("frameshift_truncation", "mRNA"),
        "frameshift block substitution": ("frameshift_variant", "mRNA"),
        "nonframeshift insertion": ("inframe_insertion", "mRNA"),
        "nonframeshift deletion": ("inframe_deletion", "mRNA"),
        "nonframeshift block substitution": ("inframe_variant", "mRNA"),
        "unknown": ("sequence_variant", "mRNA"),
        "exonic": ("exon_variant", "exon"),
        "splicing": ("splice_site_variant", "splice_site"),
        "ncRNA": ("non_coding_transcript_variant", "ncRNA"),
        "UTR5": ("5_prime_UTR_variant", "five_prime_UTR"),
        "UTR3": ("3_prime_UTR_variant", "three_prime_UTR"),
        "intronic": ("intron_variant", "transcript"),
        "upstream": ("upstream_gene_variant", "gene"),
        "downstream": ("downstream_gene_variant", "gene"),
        "intergenic": ("intergenic_variant", "intergenic_region"),
    },
}

#: Variant types that an ANNOVAR word implies (fixed values); a block substitution within the frame is an MNP if its lengths are equal.
ANNOVAR_TYPES = {
    "frameshift insertion": "insertion",
    "frameshift deletion": "deletion",
    "frameshift block substitution": "complex_substitution",
    "nonframeshift insertion": "insertion",
    "nonframeshift deletion": "deletion",
    "stopgain SNV": "SNV",
    "stoploss SNV": "SNV",
    "nonsynonymous SNV": "SNV",
    "synonymous SNV": "SNV",
    "unknown": "sequence_alteration",
}


def annovar_type(word: Column, reference: Column, allele: Column) -> Column:
    """The variant's type by its ANNOVAR word and alleles; null for words that imply none."""
    table = F.create_map(*[F.lit(x) for pair in ANNOVAR_TYPES.items() for x in pair])
    block = F.when(F.length(reference) == F.length(allele), "MNP").otherwise("complex_substitution")
    return F.when(word == "nonframeshift block substitution", block).otherwise(F.try_element_at(table, word))


def variant_effects(variants: DataFrame, dialect: str, col: str = "effects") -> DataFrame:
    """(feature_id, allele, effect, feature_type, target): one row per effect, allele and feature.

    ``col`` is the annotator's text: snpeff WORD(..|..), vep Allele|Gene|Feature|Type|effect&effect, others
    word:target, several joined by commas. A word of several terms gives a row for each. Words without an
    entry stay as they are, of unknown type. For annovar, where variants have a reference_seq, variant_type is
    the type that word and alleles imply.
    """
    each = variants.withColumn("_e", F.explode(F.split(col, ",")))
    if dialect == "vep":
        p = F.split("_e", r"\|")
        rows = each.select("feature_id", p[0].alias("allele"), F.explode(F.split(p[4], "&")).alias("effect"), F.when(p[3] == "Transcript", "transcript").otherwise(p[3]).alias("feature_type"), F.split(p[2], "&").alias("t"))
        return rows.select("feature_id", "allele", "effect", "feature_type", F.explode_outer("t").alias("target")).distinct()
    if dialect == "snpeff":
        p = F.split("_e", r"[|(]")
        rows = each.select("feature_id", F.col("variant_seq"), p[0].alias("word"), F.regexp_replace(F.coalesce(F.try_element_at(p, F.lit(10)), F.lit("")), r"\)$", "").alias("target"))
    else:
        typed = dialect == "annovar" and "reference_seq" in variants.columns
        rows = each.select("feature_id", *(["reference_seq"] if typed else []), F.col("variant_seq"), F.trim(F.substring_index("_e", ":", 1)).alias("word"), F.when(F.instr("_e", ":") > 0, F.regexp_replace("_e", "^[^:]*:", "")).otherwise("").alias("target"))
    table = variants.sparkSession.createDataFrame([(w, t.split(), f) for w, (t, f) in EFFECTS[dialect].items()], "word string, terms array<string>, kind string")
    j = rows.join(F.broadcast(table), "word", "left")  # the table is fixed
    j = j.withColumn("effect", F.explode(F.coalesce("terms", F.array("word")))).withColumn("allele", F.explode("variant_seq"))
    more = [annovar_type(F.col("word"), F.col("reference_seq"), F.col("allele")).alias("variant_type")] if "reference_seq" in j.columns else []
    return j.select("feature_id", "allele", "effect", F.coalesce("kind", F.lit("unknown")).alias("feature_type"), "target", *more).distinct()


def expand_gene_table(df: DataFrame) -> DataFrame:
    """Gene table rows (name, chrom, strand, txStart, txEnd, cdsStart, cdsEnd, exonStarts, exonEnds) to mRNA, exon and CDS rows.

    CDS parts are exons clipped to the coding range; none if it is shorter than 3.
    """
    t = df.select(F.col("name").alias("feature_id"), F.lit(None).cast("string").alias("parent"), F.lit("mRNA").alias("type"), "chrom", "strand", F.col("txStart").alias("start"), F.col("txEnd").alias("end"))
    pairs = F.arrays_zip(F.array_remove(F.split("exonStarts", ","), "").alias("s"), F.array_remove(F.split("exonEnds", ","), "").alias("e"))
    e = df.select("*", F.posexplode(pairs).alias("i", "x"))
    e = e.select(F.col("name").alias("parent"), "chrom", "strand", "cdsStart", "cdsEnd", "i", F.col("x.s").cast("long").alias("start"), F.col("x.e").cast("long").alias("end"))
    part = lambda d, kind: d.select(F.concat_ws(":", "parent", F.lit(kind), (F.col("i") + 1).cast("string")).alias("feature_id"), "parent", F.lit(kind).alias("type"), "chrom", "strand", "start", "end")
    c = e.where("cdsEnd - cdsStart >= 3 AND end >= cdsStart AND start <= cdsEnd").withColumns({"start": F.greatest("start", "cdsStart"), "end": F.least("end", "cdsEnd")})
    return t.unionByName(part(e, "exon")).unionByName(part(c, "CDS"))


def variant_calls(df: DataFrame, colmap: dict[str, str] | None = None) -> DataFrame:
    """SNV and indel calls (chrom, pos, ref, call): alleles from the consensus code or a/b of a * row, type and zygosity."""
    d = df.withColumnsRenamed({v: k for k, v in (colmap or {}).items()})
    indel = F.col("ref") == "*"
    alleles = F.array_distinct(F.split(F.upper("call"), "/"))
    plus = F.exists(alleles, lambda x: x.startswith("+"))
    bare = F.transform(alleles, lambda x: F.when(x == "*", "-").otherwise(F.regexp_replace(x, r"^[+-]", "")))
    size = F.array_max(F.transform(bare, lambda x: F.when(x == "-", 0).otherwise(F.length(x))))
    kind = F.when(~indel, "SNV").when(plus, "insertion").otherwise("deletion")
    seqs = F.when(~indel, expand_iupac(F.col("call"))).otherwise(bare)
    start = F.col("pos") + F.when(kind == "deletion", 1).otherwise(0)
    return d.withColumns({"type": kind, "start": start.cast("long"), "end": F.when(kind == "deletion", start + size - 1).otherwise(start).cast("long"), "variant_seq": seqs, "zygosity": F.when(F.size(seqs) == 1, "homozygous").otherwise("heterozygous")})


#: Columns of tabular result formats (fixed values).
TABULAR = {
    "blast": "query_id subject_id pct_identity aln_length mismatches gap_opens q_start q_end s_start s_end evalue bit_score".split(),
    "macs": "seqid start end id log10pvalue".split(),
    "cuffdiff": "test_id gene_id gene locus sample_1 sample_2 status value_1 value_2 log2_fc test_stat p_value q_value significant".split(),
}


def read_tab_features(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """BLAST hits, peak summits or differential expression as features: feature_id, seqid, source, type, start, end, score, strand."""
    p = F.split("value", r"\t")
    rows = skip_records(lines(spark, path), COMMENT + "|^test_id\\b").select(*[p[i].alias(c) for i, c in enumerate(TABULAR[kind])])
    n = lambda c: F.col(c).cast("long")
    if kind == "blast":
        back = n("s_start") > n("s_end")
        return rows.select(F.col("query_id").alias("feature_id"), F.col("subject_id").alias("seqid"), F.lit("BLAST").alias("source"), F.lit("match").alias("type"), F.least(n("s_start"), n("s_end")).alias("start"), F.greatest(n("s_start"), n("s_end")).alias("end"), F.col("bit_score").alias("score"), F.when(back, "-").otherwise("+").alias("strand"))
    if kind == "macs":
        return rows.select(F.col("id").alias("feature_id"), "seqid", F.lit("MACS").alias("source"), F.lit("experimental_feature").alias("type"), n("start").alias("start"), n("end").alias("end"), F.col("log10pvalue").alias("score"), F.lit(".").alias("strand"))
    at = F.split("locus", "[:-]")
    return rows.select(F.col("gene").alias("feature_id"), at[0].alias("seqid"), F.lit("cuffdiff").alias("source"), F.lit("gene").alias("type"), at[1].cast("long").alias("start"), at[2].cast("long").alias("end"), F.col("test_stat").alias("score"), F.lit(".").alias("strand"))


def validate_features(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry the reason of the first rule they break."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    has_id = F.col("attributes").isNotNull() & F.coalesce(F.try_element_at(F.try_element_at(F.col("attributes"), F.lit("ID")), F.lit(1)), F.lit("")).rlike(".")
    reason = F.lit(None).cast("string")
    rules = [("missing_feature_id", text("feature_id") != ""), ("missing_seqid", text("seqid") != ""), ("missing_source", text("source") != ""), ("missing_type", text("type") != ""), ("invalid_start", text("start").rlike(r"^\d+$")), ("invalid_end", text("end").rlike(r"^\d+$")),
             ("missing_score", F.col("score").isNotNull()), ("invalid_strand", text("strand").rlike(r"^[.+-]$")), ("invalid_phase", text("phase").rlike(r"^[.012]")), ("missing_attribute_ID", has_id)]
    for name, ok in reversed(rules):
        reason = F.when(~ok, name).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
