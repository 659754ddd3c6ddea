"""What a repeat contributes to a feature: categories of an overlap, as nested conditions.

A repeat covers an end of a feature if it hangs over it, that is reaches at least one base
beyond; ``inclusive`` counts a repeat that ends with the feature as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ends(te_start: str, te_end: str, start: str, end: str, strand: str, inclusive: bool) -> tuple[Column, Column]:
    """Whether the repeat covers the feature's 5' end and its 3' end."""
    low, high = F.col(te_start) < F.col(start), F.col(te_end) > F.col(end)
    if inclusive:
        low, high = F.col(te_start) <= F.col(start), F.col(te_end) >= F.col(end)
    minus = F.col(strand) == "-"
    return F.when(minus, high).otherwise(low), F.when(minus, low).otherwise(high)


def classify_exon(
    j: DataFrame,
    te_start: str = "te_st",
    te_end: str = "te_en",
    start: str = "st",
    end: str = "en",
    strand: str = "strand",
    kind: str = "exon_type",
    inclusive: bool = False,
    coding: bool = False,
) -> DataFrame:
    """Add category: which sites of the exon the repeat covers, by exon type; exonized if none.

    With ``coding`` the parts are of the CDS: its ends are ATG and STOP. A part of
    indeterminate type (indet) that is covered whole is indet.
    """
    five, three = _ends(te_start, te_end, start, end, strand, inclusive)
    head, tail = ("ATG", "STOP") if coding else ("TSS", "polyA")
    t = F.col(kind)
    cat = (
        F.when(five & three & (t == "SINGLE"), f"{head}_{tail}")
        .when(five & three & (t == "FIRST"), f"{head}_5SPL")
        .when(five & three & (t == "LAST"), f"3SPL_{tail}")
        .when(five & three & (t == "indet"), "indet")
        .when(five & three, "3SPL_exon_5SPL")
        .when(five, F.when(t.isin("SINGLE", "FIRST"), head).otherwise("3SPL"))
        .when(three, F.when(t.isin("SINGLE", "LAST"), tail).otherwise("5SPL"))
        .otherwise("exonized")
    )
    return j.withColumn("category", cat)


def exon_shares(j: DataFrame, mature: str = "mature_len") -> DataFrame:
    """Add the overlap's share of the exon and of the mature transcript, in percent."""
    return j.withColumns({"pct_exon": 100 * F.col("overlap") / (F.col("en") - F.col("st") + 1), "pct_transcript": 100 * F.col("overlap") / F.col(mature)})


def classify_intron(
    j: DataFrame, te_start: str = "te_st", te_end: str = "te_en", start: str = "st", end: str = "en", strand: str = "strand", inclusive: bool = False, sides: bool = False
) -> DataFrame:
    """Add category: 5SPL_3SPL if the repeat covers both splice sites, SPL if one, else intronized.

    With ``sides`` the one is named, 5SPL or 3SPL; an intron starts at the 5' splice site.
    """
    five, three = _ends(te_start, te_end, start, end, strand, inclusive)
    one = F.when(five, "5SPL").otherwise("3SPL") if sides else F.lit("SPL")
    return j.withColumn("category", F.when(five & three, "5SPL_3SPL").when(five | three, one).otherwise("intronized"))


def classify_flank(
    j: DataFrame, te_start: str = "te_st", te_end: str = "te_en", start: str = "st", end: str = "en", strand: str = "strand", side: str = "side", inclusive: bool = False
) -> DataFrame:
    """Add category: TSS or PolyA if the repeat reaches into the transcript (_Full if it covers the whole flank), included, partial.

    The inner edge of an upstream flank is its 3' end, that of a downstream flank its 5' end.
    """
    five, three = _ends(te_start, te_end, start, end, strand, inclusive)
    up = F.col(side) == "up"
    inner, outer = F.when(up, three).otherwise(five), F.when(up, five).otherwise(three)
    name = F.when(up, "TSS").otherwise("PolyA")
    cat = F.when(inner & outer, F.concat(name, F.lit("_Full"))).when(inner, name).when(outer, "partial").otherwise("included")
    return j.withColumn("category", cat)


def classify_shuffle(
    j: DataFrame, te_start: str = "te_st", te_end: str = "te_en", start: str = "st", end: str = "en", tr_start: str = "tr_st", tr_end: str = "tr_en", strand: str = "strand", n_exons: str = "n_exons"
) -> DataFrame:
    """Add category of the enrichment test: TSS_polyA if the repeat hangs over the whole transcript, then by the exon.

    An exon is first or last if it ends with the transcript, whatever its number.
    """
    ts, te, s, e = F.col(te_start), F.col(te_end), F.col(start), F.col(end)
    plus, minus = F.col(strand) == "+", F.col(strand) == "-"
    at_low, at_high = s == F.col(tr_start), e == F.col(tr_end)
    single = at_low & at_high
    last = ~single & ((plus & at_high) | (minus & at_low))
    first = ~single & ~last & ((plus & at_low) | (minus & at_high))
    one = F.col(n_exons) == 1
    low, high = ts < s, te > e
    head, tail = F.when(plus, low).otherwise(high), F.when(plus, high).otherwise(low)  # over the exon's 5' or 3' end
    stranded = plus | minus
    cat = (
        F.when((ts < F.col(tr_start)) & (te > F.col(tr_end)), "TSS_polyA")
        .when(low & high, F.when(first, "TSS_5SPL").when(last, "3SPL_polyA").otherwise("3SPL_exon_5SPL"))
        .when(head, F.when(stranded & (one | first), "TSS").otherwise("3SPL"))
        .when(tail, F.when(stranded & (one | last), "polyA").otherwise("5SPL"))
        .otherwise("exonized")
    )
    return j.withColumn("category", cat)


def punctual(j: DataFrame, category: str, start: str = "st", end: str = "en", strand: str = "strand") -> DataFrame:
    """Reduce features to the one base of a category: TSS and 3SPL at the 5' end, polyA and 5SPL at the 3' end."""
    minus = F.col(strand) == "-"
    head, tail = F.when(minus, F.col(end)).otherwise(F.col(start)), F.when(minus, F.col(start)).otherwise(F.col(end))
    at = head if category in ("TSS", "3SPL") else tail
    return j.withColumn("_at", at).withColumns({start: F.col("_at"), end: F.col("_at")}).drop("_at")


#: Names of the sixteen superfamily buckets and of the six class buckets, in report order (fixed values).
SUPERFAMILIES = (
    "ERV/LTRint", "ERV/LTRs", "LTR/Others", "nonLTR/LINE/L1", "nonLTR/LINE/L2,3,4", "nonLTR/LINE/Others", "nonLTR/SINE/B1,ALUs", "nonLTR/SINE/B2,MIRs", "nonLTR/SINE/B3,B4,others",
    "DNA/hAT", "DNA/TcMar", "DNA/Helitrons", "DNA/Tlr,Mavericks,Polintons", "DNA/Others", "Others", "nonTE",
)
CLASSES = ("LTR", "LINE", "SINE", "DNA", "Others", "nonTE")


def te_bucket(df: DataFrame) -> DataFrame:
    """Add superfamily (one of ``SUPERFAMILIES``) and class6 (one of ``CLASSES``) of a repeat's class and family.

    Classes are taken as written; an unknown one is Others, only the class nonTE is nonTE.
    """
    c, f = F.col("rclass"), F.col("rfam")
    ltr = c.isin("LTR", "ERV")
    sup = (
        F.when(c == "SINE", F.when(f.isin("ALU", "Alu"), "nonLTR/SINE/B1,ALUs").when(f.isin("B2", "MIR"), "nonLTR/SINE/B2,MIRs").otherwise("nonLTR/SINE/B3,B4,others"))
        .when(ltr, F.when(f.contains("ERV") & f.endswith("--int"), "ERV/LTRint").when(f.contains("ERV"), "ERV/LTRs").otherwise("LTR/Others"))
        .when(c == "LINE", F.when(f == "L1", "nonLTR/LINE/L1").when(f.isin("L2", "CR1", "RTE"), "nonLTR/LINE/L2,3,4").otherwise("nonLTR/LINE/Others"))
        .when(
            c == "DNA",
            F.when(f.contains("hAT"), "DNA/hAT")
            .when(f.contains("TcMar"), "DNA/TcMar")
            .when(f.contains("Helitron"), "DNA/Helitrons")
            .when(f.rlike("[Tt]lr|[Mm]averick|[Pp]olinton"), "DNA/Tlr,Mavericks,Polintons")
            .otherwise("DNA/Others"),
        )
        .when(c == "RC", "DNA/Helitrons")
        .when(c == "nonTE", "nonTE")
        .otherwise("Others")
    )
    six = F.when(ltr, "LTR").when(c.isin("LINE", "SINE"), c).when(c.isin("DNA", "RC"), "DNA").when(c == "nonTE", "nonTE").otherwise("Others")
    return df.withColumns({"superfamily": sup, "class6": six})


def stars(p: Column) -> Column:
    """Significance marks of a p-value: ns, *, **, ***, na for null."""
    return F.when(p.isNull(), "na").when(p > 0.05, "ns").when(p > 0.01, "*").when(p > 0.001, "**").otherwise("***")
