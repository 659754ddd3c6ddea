"""Readers and writers: derived tables are written in each format by Spark and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions.sequences import chunked
from locuspark.plans.annotation_queries import FEATURES, NEED, features
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.registry import query
from locuspark.plans.statistics_queries import SEQ, seqs, te_raw
from locuspark.sources import readers as rd
from locuspark.sources import writers as wr


def written(fx: Fixtures, name: str, rows: DataFrame, line: Column, head: list[str] = ()) -> str:
    """Write one text line per row (comment lines first) to the shared folder; returns the path."""
    path = wr.shared_path(fx.spark, name)
    out = rows.select(line.alias("value"))
    if head:
        out = fx.spark.createDataFrame([(h,) for h in head], "value string").union(out)
    out.write.text(path)
    return path


def tab(*cols: Column | str) -> Column:
    return F.concat_ws("\t", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


@query("s1_read_rmsk", "te", sql="SELECT chrom, st, en, strand, rname, rclass, rfam, CAST(block AS VARCHAR) AS block FROM te")
def s1(fx: Fixtures) -> DataFrame:
    t = te_raw(fx)
    cols = ["score", F.format_number("div", 1), F.lit("0.0"), F.lit("0.0"), "chrom", "start", "end", F.lit("(0)"), F.when(F.col("strand") == "-", "C").otherwise("+"), "rname", F.concat_ws("/", "rclass", "rfam"), "r11", "r12", "r13", "block"]
    line = F.concat(F.lit("  "), F.concat_ws("  ", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]), F.when(F.col("te_id") % 7 == 0, " *").otherwise(""))
    path = written(fx, "rmsk", t, line, ["   SW  perc perc perc  query", "score  div. del. ins.  sequence", ""])
    return rd.read_rmsk(fx.spark, path).select("chrom", "start", "end", "strand", "rname", "rclass", "rfam", "block")


@query("s2_read_te_bed", "te", sql="SELECT chrom, st, en, strand, rname, rclass, rfam, CAST(block AS VARCHAR) AS block FROM te")
def s2(fx: Fixtures) -> DataFrame:
    t = te_raw(fx)
    packed = F.concat_ws(";", F.col("score").cast("string"), F.col("div").cast("string"), F.lit("0"), F.lit("0"), "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("(0)"), "strand", "rname", F.concat_ws("/", "rclass", "rfam"), "r11", "r12", "r13", F.col("block").cast("string"))
    path = written(fx, "tebed", t, tab("chrom", "start", "end", packed, F.lit("."), F.when(F.col("strand") == "-", "C").otherwise("+")))
    return rd.read_te_bed(fx.spark, path).select("chrom", "start", "end", "strand", "rname", "rclass", "rfam", "block")


@query("s3_read_bed", "exon", sql="SELECT chrom, st + 1 AS st, en, strand, tr || '.' || k AS name, tr || '.' || k || '#' || chrom || '#' || (st + 1) || '#' || en || '#' || strand AS feature_key FROM exon")
def s3(fx: Fixtures) -> DataFrame:
    e = fx.exon.withColumn("name", F.concat_ws(".", F.col("tr").cast("string"), F.col("k").cast("string")))
    path = wr.shared_path(fx.spark, "bed")
    wr.write_bed(e, path)
    return rd.read_bed(fx.spark, path, one_based=False).select("chrom", "start", "end", "strand", "name", "feature_key")


def gtf(fx: Fixtures) -> DataFrame:
    e = fx.exon.join(fx.tr.select("tr", "tr_type"), "tr")
    att = F.concat(F.lit('gene_id "'), F.col("gene").cast("string"), F.lit('"; transcript_id "'), F.col("tr").cast("string"), F.lit('"; transcript_biotype "'), "tr_type", F.lit('";'))
    strand = F.when(F.col("strand") == "-", "-1").otherwise("1")
    path = written(fx, "gtf", e, tab(F.regexp_replace("chrom", "^chr", ""), F.lit("model"), F.lit("exon"), "start", "end", F.lit("."), strand, F.lit("."), att), ["#!genome", "", "MT\tx\texon\t1\t9\t.\t+\t.\tgene_id \"m\";"])
    return rd.read_gtf(fx.spark, path)


@query("s4_read_gtf", "exon", "tr", sql="SELECT e.chrom, e.st, e.en, e.strand, CAST(e.gene AS VARCHAR) AS gene_id, CAST(e.tr AS VARCHAR) AS transcript_id, tr_type AS transcript_type FROM exon e JOIN tr ON e.tr = tr.tr")
def s4(fx: Fixtures) -> DataFrame:
    return gtf(fx).select("chrom", "start", "end", "strand", *[F.col("attributes")[k].alias(k) for k in ("gene_id", "transcript_id", "transcript_type")])


@query("s26_exon_intervals", "exon", sql="SELECT chrom, st, en, strand, tr || '#' || chrom || ':' || st || '-' || en AS name FROM exon")
def s26(fx: Fixtures) -> DataFrame:
    return rd.exon_intervals(gtf(fx))


@query("s5_read_gff3", *NEED, sql=f"WITH {FEATURES} SELECT id AS feature_id, chrom AS seqid, type, st, en, strand, parent FROM ft")
def s5(fx: Fixtures) -> DataFrame:
    path = wr.shared_path(fx.spark, "gff3")
    wr.write_gff3(features(fx), path)
    f = rd.read_gff3(fx.spark, path)
    return f.select("feature_id", "seqid", "type", "start", "end", "strand", F.try_element_at(F.try_element_at(F.col("attributes"), F.lit("Parent")), F.lit(1)).alias("parent"))


@query("s6_read_columns_mapped", sql="SELECT n_name AS chrom, n_nationkey + 10 AS st, n_nationkey * 100 AS en, CAST(n_regionkey AS VARCHAR) AS added_4 FROM nation")
def s6(fx: Fixtures) -> DataFrame:
    t = fx.table("nation")
    path = written(fx, "mapped", t, tab("n_name", F.col("n_nationkey") * 100, F.col("n_nationkey") + 10, "n_regionkey"), ["# a comment"])
    m = written(fx, "colmap", fx.spark.createDataFrame([("chrom = 1 #name",), ("start = 3",), ("end = 2 #end",)], "l string"), F.col("l"))
    return rd.read_mapped(fx.spark, path, rd.parse_colmap(fx.spark, m), [4])


@query("s7_read_te_info", "te", sql="""SELECT lower(rname) || CASE WHEN i % 7 = 0 THEN '-int' ELSE '' END AS rname_lc, rclass, CASE WHEN i % 7 = 0 THEN 'ERV_x--int' WHEN i % 7 = 1 THEN 'ERV_x' ELSE rfam || '_x' END AS rfam, CAST(i AS DOUBLE) AS pct_div
  FROM (SELECT DISTINCT rname, rclass, rfam, CAST(replace(rname, 'R', '') AS INT) AS i FROM te)""")
def s7(fx: Fixtures) -> DataFrame:
    i = F.regexp_extract("rname", r"(\d+)", 1).cast("int")
    t = fx.te.select("rname", "rclass", "rfam").distinct().select(F.concat("rname", F.when(i % 7 == 0, "-int").otherwise("")).alias("rname"), "rclass", F.when(i % 7 < 2, "ERV").otherwise(F.col("rfam")).alias("rfam"))
    path = written(fx, "teinfo", t, tab("rname", "rclass", F.concat("rfam", F.lit("/x")), F.concat_ws("/", "rclass", "rfam"), F.regexp_extract("rname", r"(\d+)", 1), F.lit("L"), F.lit("Ancient")), ["#Rname\tRclass\tRfam"])
    again = written(fx, "teinfo2", t, tab(F.lower("rname"), "rclass", F.concat("rfam", F.lit("/x")), F.lit("a"), F.regexp_extract("rname", r"(\d+)", 1), F.lit("L"), F.lit("Ancient")), ["Rname\tRclass\tRfam"])
    return rd.read_te_info(fx.spark, [path, again]).select("rname_lc", "rclass", "rfam", "pct_div")


@query("s8_read_parsed_rm", "te", sql="""WITH p AS (SELECT rname, strand, rclass, rfam, CAST(sum(en - st + 1) AS BIGINT) AS l, count(*) AS c, CASE WHEN strand = '+' THEN 5 ELSE 0 END AS o FROM te GROUP BY ALL)
  SELECT layout, lower(rname) AS rname_lc, rclass, rfam, CAST(sum(l - o) AS BIGINT) AS g_len, CAST(sum(c) AS BIGINT) AS g_count, CAST(sum(c - 1) AS BIGINT) AS g_nr, round(sum(0.5 - CASE WHEN o > 0 THEN 0.25 ELSE 0 END), 6) AS g_pct FROM p, (VALUES ('new'), ('old'), ('old with Rlen')) v(layout) GROUP BY ALL""")
def s8(fx: Fixtures) -> DataFrame:
    t = fx.te.groupBy("rname", "strand", "rclass", "rfam").agg(F.sum(F.col("end") - F.col("start") + 1).alias("l"), F.count(F.lit(1)).alias("n"))
    plus, x = F.col("strand") == "+", F.lit("1.0")
    over, share = F.when(plus, "5").otherwise("0"), F.when(plus, "0.25").otherwise("0")
    names, full, less = ["rname", "rclass", "rfam"], F.concat_ws("#", "rname", "rclass"), F.col("n") - 1
    layouts = {
        "new": (tab(*names, F.lit(900), "n", less, "l", *[x] * 7, F.lit("0.5"), over, share, x), "#Rname\tRclass\tRfam\tRlen\tFRG_NB_all\tFRG_NB_Reconstructed_repeats\tLEN_MASKED_NR"),
        "old": (tab(*names, full, x, "n", x, less, *[x] * 6, "l", x, x, F.lit("0.5"), over, share, x), "#Rname\tRclass\tRfam\tRfullname\tx\tFRG_NB\tFRG_NB_StartToEnd\tNR_FRG_NB\tMED_LEN_MASKED"),
        "old with Rlen": (tab(*names, full, F.lit(900), x, "n", x, less, *[x] * 6, "l", x, x, F.lit("0.5"), over, share, x), "#Rname\tRclass\tRfam\tRfullname\tRlen\tx\tFRG_NB\tFRG_NB_StartToEnd\tNR_FRG_NB\tMED_LEN_MASKED"),
    }
    got = [rd.read_parsed_rm(fx.spark, written(fx, "parsedrm", t, line, [head])).withColumn("layout", F.lit(k)) for k, (line, head) in layouts.items()]
    return rd.concat_inputs(*got).withColumn("g_pct", F.round("g_pct", 6))


@query("s9_read_genome_sizes", "sizes", sql="SELECT chrom, length FROM sizes")
def s9(fx: Fixtures) -> DataFrame:
    return rd.read_sizes(fx.spark, written(fx, "sizes", fx.sizes, tab("chrom", "length")))


def fasta(fx: Fixtures) -> str:
    path = wr.shared_path(fx.spark, "fasta")
    wr.write_fasta(seqs(fx).where(F.length("seq") > 0), path, F.concat_ws(" ", F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("a document")))
    return path


@query("s10_fasta_lengths", sql=f"WITH {SEQ} SELECT 'd' || doc_id AS chrom, length(seq) AS length FROM sq WHERE length(seq) > 0")
def s10(fx: Fixtures) -> DataFrame:
    return rd.fasta_lengths(fx.spark, fasta(fx))


@query("s23_write_fasta", sql=f"WITH {SEQ} SELECT 'd' || doc_id AS chrom, md5(seq) AS h FROM sq WHERE length(seq) > 0")
def s23(fx: Fixtures) -> DataFrame:
    return rd.fasta_records(fx.spark, fasta(fx)).select("chrom", F.md5("seq").alias("h"))


@query("s11_gap_table", "te", sql="SELECT chrom, st AS st, en FROM te WHERE en - st >= 400")
def s11(fx: Fixtures) -> DataFrame:
    path = written(fx, "gaps", fx.te, tab(F.lit(585), "chrom", "start", "end", F.lit(1), F.lit("N"), F.lit(10), F.lit("clone"), F.lit("no")), ["#bin\tchrom"])
    return rd.gaps_from_table(rd.read_gaps(fx.spark, path), 400)


@query("s13_concat_inputs", "te", "exon", sql="SELECT chrom, st, en FROM te UNION ALL SELECT chrom, st, en FROM exon")
def s13(fx: Fixtures) -> DataFrame:
    c = ["chrom", "start", "end"]
    return rd.concat_inputs(fx.te.select(*c), fx.exon.select(*c))


@query("s27_read_many", "exon", sql="SELECT 'strand=' || CASE WHEN strand = '-' THEN 'm' ELSE 'p' END AS run, count(*) AS n FROM exon GROUP BY 1")
def s27(fx: Fixtures) -> DataFrame:
    path = wr.shared_path(fx.spark, "many")
    for s, n in (("+", "p"), ("-", "m")):
        wr.write_bed(fx.exon.where(F.col("strand") == s), f"{path}/strand={n}")
    got = rd.read_many(fx.spark, f"{path}/*", rd.read_bed, r"(strand=[^/]+)/")
    return got.groupBy("run").agg(F.count(F.lit(1)).alias("n"))


VCF = "vc AS (SELECT DISTINCT chrom, st, CASE te_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'AC' ELSE 'G' END AS ref, CASE te_id % 3 WHEN 0 THEN 'G,T' WHEN 1 THEN 'A' ELSE 'GTT' END AS alt, te_id FROM te)"


def vcf(fx: Fixtures) -> DataFrame:
    m = F.col("te_id") % 3
    ref, alt = F.when(m == 0, "A").when(m == 1, "AC").otherwise("G"), F.when(m == 0, "G,T").when(m == 1, "A").otherwise("GTT")
    info = F.concat(F.lit("DP="), F.col("score").cast("string"), F.lit(";AF=0.5,0.25;DB"))
    path = written(fx, "vcf", fx.te, tab("chrom", "start", F.concat(F.lit("v"), F.col("te_id").cast("string")), ref, alt, F.lit("50"), F.lit("PASS"), info, F.lit("GT"), F.lit("0/1"), F.lit("1/1")), ["##fileformat=VCFv4.1", "#CHROM\tPOS"])
    return rd.read_vcf(fx.spark, path)


@query("s14_read_vcf", "te", sql=f"WITH {VCF} SELECT 'v' || te_id AS feature_id, chrom AS seqid, st, st + length(ref) - 1 AS en, CASE ref WHEN 'A' THEN 'SNV' WHEN 'AC' THEN 'deletion' ELSE 'insertion' END AS type, alt, '0.5|0.25' AS af, 2 AS n_samples FROM vc")
def s14(fx: Fixtures) -> DataFrame:
    return vcf(fx).select("feature_id", "seqid", "start", "end", "type", F.array_join("variant_seq", ",").alias("alt"), F.array_join(F.col("attributes")["vcf_AF"], "|").alias("af"), F.size("samples").alias("n_samples"))


@query("s15_variant_effects", "te", sql=f"""WITH {VCF}, a AS (SELECT te_id, unnest(string_split(alt, ',')) AS allele FROM vc)
  SELECT 'v' || te_id AS feature_id, allele, e AS effect, f AS feature_type, 'ENST' || te_id AS target FROM a, (VALUES ('missense_variant', 'mRNA'), ('upstream_gene_variant', 'gene')) x(e, f)""")
def s15(fx: Fixtures) -> DataFrame:
    t = F.concat(F.lit("ENST"), F.substring("feature_id", 2, 20))
    eff = lambda w: F.concat(F.lit(w + "(HIGH|a|b|c|d|e|f|g|"), t, F.lit("|1)"))
    v = vcf(fx).withColumn("effects", F.concat_ws(",", eff("NON_SYNONYMOUS_CODING"), eff("UPSTREAM")))
    return rd.variant_effects(v, "snpeff")


@query("s16_gene_table_expand", "exon", "cds", "tr", sql="""SELECT type, count(*) AS n, CAST(sum(en - st + 1) AS BIGINT) AS bases FROM (SELECT 'mRNA' AS type, st, en FROM tr UNION ALL SELECT 'exon', st, en FROM exon
  UNION ALL SELECT 'CDS', greatest(e.st, t.st + 40), least(e.en, t.en - 40) FROM exon e JOIN tr t ON e.tr = t.tr WHERE t.en - t.st - 80 >= 3 AND e.en >= t.st + 40 AND e.st <= t.en - 40) GROUP BY type""")
def s16(fx: Fixtures) -> DataFrame:
    joined = lambda c: F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda x: x[c].cast("string")), ","), F.lit(","))
    g = fx.exon.groupBy("tr").agg(F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.min("start").alias("txStart"), F.max("end").alias("txEnd"), joined("start").alias("exonStarts"), joined("end").alias("exonEnds"))
    g = g.select(F.col("tr").cast("string").alias("name"), "chrom", "strand", "txStart", "txEnd", (F.col("txStart") + 40).alias("cdsStart"), (F.col("txEnd") - 40).alias("cdsEnd"), "exonStarts", "exonEnds")
    return rd.expand_gene_table(g).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


@query("s17_read_variant_calls", "te", sql="""SELECT te_id, CASE te_id % 4 WHEN 0 THEN 'insertion' WHEN 1 THEN 'deletion' ELSE 'SNV' END AS type, CASE te_id % 4 WHEN 0 THEN 'GT' WHEN 1 THEN '-,CA' WHEN 2 THEN 'A,G' ELSE 'C' END AS alleles,
  CASE te_id % 4 WHEN 0 THEN 'homozygous' WHEN 3 THEN 'homozygous' ELSE 'heterozygous' END AS zygosity, CASE WHEN te_id % 4 = 1 THEN st + 1 ELSE st END AS st, CASE WHEN te_id % 4 = 1 THEN st + 2 ELSE st END AS en FROM te""")
def s17(fx: Fixtures) -> DataFrame:
    m = F.col("te_id") % 4
    d = fx.te.select("te_id", "chrom", F.col("start").alias("position"), F.when(m < 2, "*").otherwise("A").alias("ref"), F.when(m == 0, "+gt/+gt").when(m == 1, "*/-ca").when(m == 2, "R").otherwise("C").alias("call"))
    return rd.variant_calls(d, {"pos": "position"}).select("te_id", "type", F.array_join("variant_seq", ",").alias("alleles"), "zygosity", "start", "end")


@query("s18_read_hits", "exon", sql="SELECT 'q' || tr || '.' || k AS feature_id, chrom AS seqid, st, en, strand FROM exon")
def s18(fx: Fixtures) -> DataFrame:
    minus = F.col("strand") == "-"
    path = written(fx, "blast", fx.exon, tab(F.concat(F.lit("q"), F.concat_ws(".", F.col("tr").cast("string"), F.col("k").cast("string"))), "chrom", F.lit(99.1), F.lit(10), F.lit(0), F.lit(0), F.lit(1), F.lit(10), F.when(minus, F.col("end")).otherwise(F.col("start")), F.when(minus, F.col("start")).otherwise(F.col("end")), F.lit("1e-9"), F.lit(50)))
    return rd.read_tab_features(fx.spark, path, "blast").select("feature_id", "seqid", "start", "end", "strand")


@query("s18_read_peaks", "peak", sql="SELECT 'p' || peak_id AS feature_id, chrom AS seqid, st, en FROM peak")
def s18b(fx: Fixtures) -> DataFrame:
    path = written(fx, "macs", fx.peak, tab("chrom", "start", "end", F.concat(F.lit("p"), F.col("peak_id").cast("string")), "value"))
    return rd.read_tab_features(fx.spark, path, "macs").select("feature_id", "seqid", "start", "end")


@query("s18_read_expression", "tr", sql="SELECT 't' || tr AS feature_id, chrom AS seqid, st, en FROM tr")
def s18c(fx: Fixtures) -> DataFrame:
    name = F.concat(F.lit("t"), F.col("tr").cast("string"))
    where = F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    zero = [F.lit("0")] * 7
    path = written(fx, "cuffdiff", fx.tr, tab(name, name, name, where, F.lit("a"), F.lit("b"), F.lit("OK"), *zero[:6], F.lit("no")), ["test_id\tgene_id"])
    return rd.read_tab_features(fx.spark, path, "cuffdiff").select("feature_id", "seqid", "start", "end")


@query("s19_validate_features", *NEED, sql=f"WITH {FEATURES} SELECT CASE WHEN type = 'CDS' THEN 'invalid_strand' WHEN type = 'gene' THEN 'missing_attribute_ID' ELSE 'good' END AS reason, count(*) AS n FROM ft GROUP BY 1")
def s19(fx: Fixtures) -> DataFrame:
    f = features(fx).withColumns({"strand": F.when(F.col("type") == "CDS", "?").otherwise(F.col("strand")), "attributes": F.when(F.col("type") == "gene", F.create_map(F.lit("Name"), F.array(F.lit("x")))).otherwise(F.col("attributes"))})
    good, bad = rd.validate_features(f)
    return good.select(F.lit("good").alias("reason")).union(bad.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("s20_skip_records", sql="SELECT n_name AS value FROM nation")
def s20(fx: Fixtures) -> DataFrame:
    path = written(fx, "lines", fx.table("nation"), F.col("n_name"), ["# comment", "", "track name=x"])
    return rd.skip_records(rd.lines(fx.spark, path), metadata="^track").select("value")


@query("u3_header_parser", sql="SELECT 'genome' AS key, 'x1' AS value")
def u3(fx: Fixtures) -> DataFrame:
    path = written(fx, "header", fx.table("nation"), F.col("n_name"), ["##genome x1", "#other"])
    parse = lambda d: d.select(F.regexp_extract("value", r"^##(\w+)", 1).alias("key"), F.regexp_extract("value", r"^##\w+\s+(.*)$", 1).alias("value"))
    return rd.header_lines(rd.lines(fx.spark, path), "^##", parse)


@query("s21_write_bed", "exon", sql="SELECT chrom, st, en, '.' AS name, strand FROM exon")
def s21(fx: Fixtures) -> DataFrame:
    path = wr.shared_path(fx.spark, "bed")
    wr.write_bed(fx.exon, path, partition_by="chrom")
    return rd.read_bed(fx.spark, path).select("chrom", "start", "end", "name", "strand")


@query("s22_write_gff3", *NEED, sql=f"WITH {FEATURES} SELECT chrom || chr(9) || 'model' || chr(9) || type || chr(9) || st || chr(9) || en || chr(9) || '.' || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=' || id || CASE WHEN parent IS NOT NULL THEN ';Parent=' || parent ELSE '' END AS line FROM ft")
def s22(fx: Fixtures) -> DataFrame:
    return wr.gff3_lines(features(fx)).select("line")


@query("s22_gff3_with_children", *NEED, sql=f"""WITH {FEATURES}, g AS (SELECT id FROM ft WHERE type = 'gene' AND CAST(substr(id, 2) AS BIGINT) % 3 = 0), t AS (SELECT ft.id FROM ft JOIN g ON ft.parent = g.id), w AS (SELECT id FROM g UNION SELECT id FROM t UNION SELECT ft.id FROM ft JOIN t ON ft.parent = t.id)
  SELECT type, count(*) AS n, CAST(sum(en - st + 1) AS BIGINT) AS bases FROM ft JOIN w USING (id) GROUP BY type""")
def s22_children(fx: Fixtures) -> DataFrame:
    f = features(fx)
    roots = f.where((F.col("type") == "gene") & (F.substring("feature_id", 2, 20).cast("long") % 3 == 0))
    return wr.with_children(f, roots).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


@query("s23_fasta_headers", *NEED, sql=f"""WITH {FEATURES}, r AS (SELECT id, row_number() OVER (PARTITION BY parent, type ORDER BY CASE WHEN strand = '-' THEN -en ELSE st END, id) AS m, count(*) OVER (PARTITION BY parent, type) AS n FROM ft WHERE parent IS NOT NULL)
  SELECT id || ' locus=' || chrom || ':' || st || '-' || en || ';strand=' || strand || ';type=' || type || ';' || CASE WHEN parent IS NOT NULL THEN 'parent=' || parent || ';' ELSE '' END || CASE WHEN n > 1 THEN 'sib_count=' || m || ':' || n || ';' ELSE '' END AS header FROM ft LEFT JOIN r USING (id)""")
def s23_headers(fx: Fixtures) -> DataFrame:
    return wr.fasta_headers(features(fx)).select("header")


@query("s24_write_report", "te", sql="SELECT rclass, CAST(count(*) AS VARCHAR) AS n, CASE WHEN rclass <> 'RC' THEN CAST(max(score) AS VARCHAR) END AS top FROM te GROUP BY rclass")
def s24(fx: Fixtures) -> DataFrame:
    r = fx.te.groupBy("rclass").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("rclass") != "RC", F.col("score"))).alias("top"))
    path = wr.shared_path(fx.spark, "report")
    wr.write_report(r, path)
    return wr.read_report(fx.spark, path)


@query("s25_concat_reports", "exon", "cds", sql="SELECT 'exon' AS feature_class, count(*) AS n FROM exon UNION ALL SELECT 'cds', count(*) FROM cds")
def s25(fx: Fixtures) -> DataFrame:
    n = lambda d, name: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feature_class"), "n")
    return rd.concat_inputs(n(fx.exon, "exon"), n(fx.cds, "cds"))


@query("q4_chunk_sequence", sql=f"WITH {SEQ} SELECT doc_id, CAST(count(*) AS BIGINT) AS chunks, CAST(sum(len) AS BIGINT) AS bases FROM (SELECT doc_id, unnest(range(0, length(seq), 500)) AS o, length(substr(seq, o + 1, 500)) AS len FROM sq WHERE length(seq) > 0) GROUP BY doc_id".replace("unnest(range(0, length(seq), 500)) AS o, length(substr(seq, o + 1, 500)) AS len FROM sq WHERE length(seq) > 0", "o, least(500, length(seq) - o) AS len FROM sq, LATERAL (SELECT unnest(range(0, length(seq), 500)) AS o)"))
def q4b(fx: Fixtures) -> DataFrame:
    c = chunked(seqs(fx).select(F.col("doc_id").alias("chrom"), "seq"), 500)
    return c.groupBy(F.col("chrom").alias("doc_id")).agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("seq")).cast("long").alias("bases"))
