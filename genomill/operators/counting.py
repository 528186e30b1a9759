"""Building the relational core and counting on it: families, genomes, matrices, core sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.trees import settle

def build_proteins(products: DataFrame, families: DataFrame) -> DataFrame:
    """One row per protein and family, with the smallest product."""
    return products.join(families, "nr_protein_id").groupBy("nr_protein_id", "protein_family_id").agg(F.min("product").alias("product"))


def build_cds(cds: DataFrame, orfan: int) -> DataFrame:
    """A coding sequence with a protein but without family belongs to the ORFan family."""
    family = F.coalesce("gene_family_id", F.when(F.col("nr_protein_id").isNotNull(), F.lit(orfan)))
    return cds.withColumn("gene_family_id", family)


def cds_genomes(cds: DataFrame, replicons: DataFrame, assemblies: DataFrame) -> DataFrame:
    """Coding sequences with their replicon and assembly."""
    return cds.join(replicons, "genomic_accession").join(assemblies, "assembly_id")


def cds_codes(genomes: DataFrame) -> DataFrame:
    """B1: genome code, an underscore, and the number of the gene."""
    return genomes.withColumn("cds_code", F.concat_ws("_", "code", F.col("cds_no").cast("string")))


def orphan_families(genes: DataFrame, proteins: DataFrame) -> DataFrame:
    """C4: gene families without a protein family."""
    return genes.select("gene_family_id").where("gene_family_id IS NOT NULL").distinct().join(proteins.select(F.col("nr_protein_id").alias("gene_family_id")), "gene_family_id", "left_anti")


def exclude(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't listed."""
    return df.join(listed.select(key), key, "left_anti")


def restrict(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(listed.select(key), key, "left_semi")


def id_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids that only one of two sources has, and which."""
    return a.select(key).distinct().withColumn("_a", F.lit(1)).join(b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full_outer").where("_a IS NULL OR _b IS NULL").select(key, F.when(F.col("_a").isNull(), "second").otherwise("first").alias("only_in"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C17: keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def count_mismatches(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys whose row counts differ between two sources (absent: 0)."""
    x, y = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((a, "n_first"), (b, "n_second")))
    both = x.join(y, key, "full_outer").fillna(0, ["n_first", "n_second"])
    return both.where("n_first <> n_second")


def family_sizes(genomes: DataFrame) -> DataFrame:
    """Genes of each family, and the genomes that have it."""
    return genomes.where("gene_family_id IS NOT NULL").groupBy("gene_family_id").agg(F.count("*").alias("size"), F.countDistinct("assembly_id").alias("genome_present"))


def og_sizes(groups: DataFrame, members: DataFrame, families: DataFrame, collection: int) -> DataFrame:
    """Size and occurrence of each orthologous group of a collection, and of families without any group in it (og_id null)."""
    own = groups.where(F.col("ortholog_col_id") == collection)
    sized = own.join(members, "rlocds_id").groupBy("gene_family_id", "og_id").agg(F.count("*").alias("size"), F.countDistinct("genome").alias("genome_present"))
    rest = families.join(own.select("gene_family_id").distinct(), "gene_family_id", "left_anti").join(members, "rlocds_id").groupBy("gene_family_id").agg(F.count("*").alias("size"), F.countDistinct("genome").alias("genome_present"))
    return sized.unionByName(rest.withColumn("og_id", F.lit(None).cast("int")))


def family_dims(genomes: DataFrame, orfan: int) -> DataFrame:
    """D3: families, whether they have one gene only, and whether they are the ORFan family."""
    return genomes.where("gene_family_id IS NOT NULL").groupBy("gene_family_id").agg((F.count("*") == 1).alias("is_singleton")).withColumn("is_orfan", F.col("gene_family_id") == orfan)


def gene_counts(genes: DataFrame, genome: str = "genome") -> DataFrame:
    """Genes of each family in each genome (long form of the count matrix)."""
    return genes.where("gene_family_id IS NOT NULL").groupBy("gene_family_id", F.col(genome).alias("genome")).agg(F.count("*").alias("n"))


def matrix(counts: DataFrame, genomes: Sequence, prefix: str = "g") -> DataFrame:
    """The wide form, a column for each of the given genomes in order; 0 where a family is absent."""
    named = counts.withColumn("genome", F.concat(F.lit(prefix), F.col("genome").cast("string")))
    return named.groupBy("gene_family_id").pivot("genome", [f"{prefix}{g}" for g in genomes]).agg(F.sum("n")).fillna(0)


def og_counts(families: DataFrame, groups: DataFrame, genome: str = "genome") -> DataFrame:
    """Genes per family and group in each genome; `row_label` is fam-og, or fam without a group; `one_genome`: found in one genome only."""
    named = families.join(groups.select("rlocds_id", "og_id"), "rlocds_id", "left")
    counts = named.groupBy("gene_family_id", "og_id", F.col(genome).alias("genome")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("row_label", F.concat_ws("-", F.col("gene_family_id").cast("string"), F.col("og_id").cast("string")))
    return counts.withColumn("one_genome", F.count("*").over(Window.partitionBy("row_label")) == 1)


def replicon_families(genomes: DataFrame, replicon_type: str, least: int) -> DataFrame:
    """Counts per replicon of a type, of families found on `least` such replicons."""
    counts = genomes.where((F.col("replicon_type") == replicon_type) & F.col("gene_family_id").isNotNull()).groupBy("gene_family_id", "genomic_accession").agg(F.count("*").alias("n"))
    often = counts.groupBy("gene_family_id").agg(F.count("*").alias("_r")).where(F.col("_r") >= least)
    return counts.join(often.select("gene_family_id"), "gene_family_id", "left_semi")


def core_families(counts: DataFrame, n_genomes: int) -> DataFrame:
    """Families with exactly one gene in every genome."""
    return counts.groupBy("gene_family_id").agg(F.count("*").alias("_g"), F.max("n").alias("_m")).where((F.col("_g") == n_genomes) & (F.col("_m") == 1)).select("gene_family_id")


def unicopy_presence(counts: DataFrame) -> DataFrame:
    """Families that no genome has twice, and the genomes that have them."""
    return counts.groupBy("gene_family_id").agg(F.count("*").alias("present"), F.max("n").alias("_m")).where("_m = 1").drop("_m")


def pseudo_core(counts: DataFrame, least: Sequence[int]) -> DataFrame:
    """For each threshold the single-copy families present in that many genomes."""
    return unicopy_presence(counts).select("gene_family_id", "present", F.explode(F.array(*map(F.lit, least))).alias("min_genomes")).where("present >= min_genomes")


def presence_cumulative(counts: DataFrame, n_genomes: int | None = None) -> DataFrame:
    """How many single-copy families are present in n genomes or more, for each n that occurs; or, of `n_genomes`, for each n from three quarters of them on."""
    per_n = unicopy_presence(counts).groupBy("present").agg(F.count("*").alias("_c"))  # a row for each number of genomes
    if n_genomes is not None:
        grid = counts.sparkSession.range(3 * n_genomes // 4, n_genomes + 1).withColumnRenamed("id", "n_genomes")
        return grid.join(F.broadcast(per_n), F.col("present") >= F.col("n_genomes"), "left").groupBy("n_genomes").agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n_families"))
    return per_n.select(F.col("present").alias("n_genomes"), F.sum("_c").over(Window.orderBy(F.desc("present"))).alias("n_families"))


def missing_markers(counts: DataFrame, families: DataFrame, genomes: DataFrame, top: int | None = None) -> DataFrame:
    """Markers that each genome lacks: all of them less those it has, so that no grid is made; or the `top` genomes that lack most, by genome where they lack as many."""
    have = counts.join(families.select("gene_family_id"), "gene_family_id", "left_semi").groupBy("genome").agg(F.count("*").alias("_h"))
    total = families.agg(F.count("*").alias("_all"))
    missing = genomes.join(have, "genome", "left").join(total).select("genome", (F.col("_all") - F.coalesce("_h", F.lit(0))).alias("n_missing"))
    return missing if top is None else missing.orderBy(F.desc("n_missing"), "genome").limit(top)


def family_bands(sizes: DataFrame, bands: Sequence[tuple[int, int | None]]) -> DataFrame:
    """the band (from 1) of each family's size; families in no band are left out."""
    band = F.lit(None).cast("int")
    for i, (lo, hi) in reversed([*enumerate(bands, 1)]):
        band = F.when((F.col("size") >= lo) & (F.col("size") <= hi if hi is not None else F.lit(True)), i).otherwise(band)
    return sizes.withColumn("band", band).where("band IS NOT NULL")


def pangenome_class(sizes: DataFrame, core_share: float = 0.98, multi: float = 0.10) -> DataFrame:
    """Core or accessory (of the largest occurrence), single or multi-copy."""
    top = sizes.agg(F.max("genome_present").alias("_n"))
    return sizes.join(top).select(*sizes.columns, F.when(F.col("genome_present") >= core_share * F.col("_n"), "core").otherwise("accessory").alias("pangenome"), F.when((F.col("size") - F.col("genome_present")) / F.col("genome_present") <= multi, "single-copy").otherwise("multi-copy").alias("copies"))


def _all_pairs(near: DataFrame, genomes: DataFrame) -> DataFrame:
    """`near` (genome_1, genome_2, distance) with the other pairs of genomes at distance 1: a full matrix, and so as large as one."""
    a, b = (genomes.select(F.col("genome").alias(g)) for g in ("genome_1", "genome_2"))
    return a.join(b, F.col("genome_1") < F.col("genome_2")).join(near, ["genome_1", "genome_2"], "left").withColumn("distance", F.coalesce("distance", F.lit(1.0)))


def jaccard_distances(counts: DataFrame, full: bool = False) -> DataFrame:
    """H1: 1 - shared / united families of two genomes, for pairs that share a family; `full`: for all pairs."""
    own = counts.groupBy("genome").agg(F.count("*").alias("_s"))
    a, b = (counts.select("gene_family_id", F.col("genome").alias(g)) for g in ("genome_1", "genome_2"))
    shared = a.join(b, "gene_family_id").where("genome_1 < genome_2").groupBy("genome_1", "genome_2").agg(F.count("*").alias("_k"))
    sized = shared.join(own.select(F.col("genome").alias("genome_1"), F.col("_s").alias("_1")), "genome_1").join(own.select(F.col("genome").alias("genome_2"), F.col("_s").alias("_2")), "genome_2")
    near = sized.select("genome_1", "genome_2", F.round(1 - F.col("_k") / (F.col("_1") + F.col("_2") - F.col("_k")), 9).alias("distance"))
    return _all_pairs(near, own) if full else near


def bray_curtis(counts: DataFrame, full: bool = False) -> DataFrame:
    """H2: 1 - 2 * sum of smaller counts / all counts of two genomes, for pairs that share a family; `full`: for all pairs."""
    own = counts.groupBy("genome").agg(F.sum("n").alias("_s"))
    a, b = (counts.select("gene_family_id", F.col("genome").alias(g), F.col("n").alias(f"_n{i}")) for i, g in ((1, "genome_1"), (2, "genome_2")))
    shared = a.join(b, "gene_family_id").where("genome_1 < genome_2").groupBy("genome_1", "genome_2").agg(F.sum(F.least("_n1", "_n2")).alias("_k"))
    sized = shared.join(own.select(F.col("genome").alias("genome_1"), F.col("_s").alias("_1")), "genome_1").join(own.select(F.col("genome").alias("genome_2"), F.col("_s").alias("_2")), "genome_2")
    near = sized.select("genome_1", "genome_2", F.round(1 - 2 * F.col("_k") / (F.col("_1") + F.col("_2")), 9).alias("distance"))
    return _all_pairs(near, own) if full else near


def clade_sides(counts: DataFrame, clades: DataFrame) -> DataFrame:
    """Per clade and family: genomes of the clade and of its contrast that have the family, and the clade's sizes."""
    sizes = clades.groupBy("clade").agg(F.sum((F.col("side") == "clade").cast("long")).alias("n_in"), F.sum((F.col("side") == "contrast").cast("long")).alias("n_out"))
    seen = counts.join(clades, "genome").groupBy("clade", "gene_family_id").agg(F.sum((F.col("side") == "clade").cast("long")).alias("has_in"), F.sum((F.col("side") == "contrast").cast("long")).alias("has_out"))
    return seen.join(sizes, "clade")


def _limits(sides: DataFrame, relax: float, limits: DataFrame | None) -> DataFrame:
    """`sides` with maxabsin, maxpresout, maxpresin, maxabsout: as `limits` (clade and any of these) give them, else round(size * relax), halves to even."""
    named = {"maxabsin": "n_in", "maxpresout": "n_out", "maxpresin": "n_in", "maxabsout": "n_out"}
    given = [c for c in named if limits is not None and c in limits.columns]
    if given:
        sides = sides.join(limits.select("clade", *[F.col(c).alias(f"_{c}") for c in given]), "clade", "left")
    default = {c: F.bround(F.col(n) * relax) for c, n in named.items()}
    return sides.withColumns({c: F.coalesce(f"_{c}", default[c]) if c in given else default[c] for c in named})


def specific_presence(counts: DataFrame, clades: DataFrame, relax: float, limits: DataFrame | None = None) -> DataFrame:
    """Families that at most maxabsin genomes of a clade lack and at most maxpresout of its contrast have."""
    s = _limits(clade_sides(counts, clades), relax, limits)
    return s.where("n_in - has_in <= maxabsin AND has_out <= maxpresout").select("clade", "gene_family_id", "has_in", "has_out")


def specific_absence(counts: DataFrame, clades: DataFrame, relax: float, limits: DataFrame | None = None) -> DataFrame:
    """The mirror image, by maxpresin and maxabsout. Only families that some genome of the clade or its contrast has are asked about."""
    s = _limits(clade_sides(counts, clades), relax, limits)
    return s.where("has_in <= maxpresin AND n_out - has_out <= maxabsout").select("clade", "gene_family_id", "has_in", "has_out")


def reference_genomes(clades: DataFrame, preferred: Sequence) -> DataFrame:
    """The first preferred genome of each clade, else its smallest."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, preferred)), F.col("genome")), F.lit(0))
    order = F.struct(F.when(rank == 0, len(preferred) + 1).otherwise(rank), "genome")
    return clades.where("side = 'clade'").groupBy("clade").agg(F.min_by("genome", order).alias("genome"))


def breaches(counts: DataFrame, clades: DataFrame, families: DataFrame) -> DataFrame:
    """Contrast genomes that have a clade's family nevertheless, listed in order."""
    return families.join(counts.join(clades.where("side = 'contrast'"), "genome"), ["clade", "gene_family_id"]).groupBy("clade", "gene_family_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("genome").cast("string"))), ",").alias("genomes"))


def annotation_lines(annotations: DataFrame, terms: DataFrame) -> DataFrame:
    """The distinct terms of each protein in one line.

    A line is made once for each set of domains that some protein has, and proteins take theirs whole, so that no row is made for each
    protein and term.
    """
    sets = settle(annotations.groupBy("nr_protein_id").agg(F.array_sort(F.collect_set("interpro_id")).alias("_set")))
    each = sets.select("_set").distinct().select("_set", F.explode("_set").alias("interpro_id"))
    lines = each.join(terms.select("interpro_id", "go_id").where("go_id IS NOT NULL").distinct(), "interpro_id").groupBy("_set").agg(F.array_join(F.array_sort(F.collect_set("go_id")), "|").alias("go_terms"))
    return sets.join(lines, "_set").select("nr_protein_id", "go_terms")


def pathway_lines(annotations: DataFrame, pathways: DataFrame) -> DataFrame:
    """The distinct pathways of each protein in one line, as `db:id`. `pathways` (interpro_id, db, pathway_id)."""
    named = pathways.where("db IS NOT NULL AND pathway_id IS NOT NULL").select("interpro_id", F.concat_ws(":", "db", "pathway_id").alias("go_id"))
    return annotation_lines(annotations, named).withColumnRenamed("go_terms", "pathways")


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1: Stirling's series eight places further on, and the way back."""
    z = x + 8.0
    series = (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    back = x
    for i in range(1, 8):
        back = back * (x + float(i))
    return series - F.ln(back)


def hypergeometric_tail(k: Column, n: Column, m: Column, total: Column) -> Column:
    """Chance that at least k of n drawn genes have a term that m of `total` have.

    The term at one end comes from log-gamma, all others from the ratio of one to the next; the sum runs away from the mode: up
    from k beyond the mean, else down from k - 1 for the rest that is taken from 1.
    """
    k, n, m, total = (c.cast("double") for c in (k, n, m, total))
    one = lambda x: log_gamma(x + 1.0)
    at = lambda i: F.exp(one(m) - one(i) - one(m - i) + one(total - m) - one(n - i) - one(total - m - n + i) - one(total) + one(n) + one(total - n))
    last, first = F.least(n, m), F.greatest(F.lit(0.0), n + m - total)
    begin = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def summed(places: Column, ratio) -> Column:
        step = lambda acc, i: F.struct((acc["term"] * ratio(i)).alias("term"), (acc["sum"] + acc["term"] * ratio(i)).alias("sum"))
        return F.aggregate(places, begin, step, lambda acc: acc["sum"])

    none = F.array().cast("array<double>")
    upward = F.when(k < last, F.transform(F.sequence(k.cast("long"), last.cast("long") - 1), lambda i: i.cast("double"))).otherwise(none)
    downward = F.when(k - 1 > first, F.transform(F.sequence(k.cast("long") - 1, first.cast("long") + 1, F.lit(-1).cast("long")), lambda i: i.cast("double"))).otherwise(none)
    above = at(k) * summed(upward, lambda i: (m - i) * (n - i) / ((i + 1.0) * (total - m - n + i + 1.0)))
    below = at(k - 1.0) * summed(downward, lambda i: i * (total - m - n + i) / ((m - i + 1.0) * (n - i + 1.0)))
    return F.when(k <= first, 1.0).when(k * total > n * m, above).otherwise(1.0 - below)


def enrichment(study: DataFrame, population: DataFrame) -> DataFrame:
    """Per study and term, genes with the term in study (k of n) and population (m of all), and Fisher's one-sided p, the hypergeometric tail.

    `study` (study, gene), `population` (gene, term); genes without a term count in no total.
    """
    genes = population.select("gene").distinct()
    totals = genes.agg(F.count("*").alias("all"))
    m = population.distinct().groupBy("term").agg(F.count("*").alias("m"))
    inside = study.distinct().join(genes, "gene")
    n = inside.groupBy("study").agg(F.count("*").alias("n"))
    k = inside.join(population.distinct(), "gene").groupBy("study", "term").agg(F.count("*").alias("k"))
    table = k.join(n, "study").join(m, "term").join(totals)
    tail = hypergeometric_tail(F.col("k"), F.col("n"), F.col("m"), F.col("all"))
    return table.select("study", "term", "k", "n", "m", "all", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)), 9).alias("p"))
