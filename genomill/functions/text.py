"""Column functions on names, dates and labels; all built from Spark's own expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def genome_codes(assemblies: DataFrame) -> DataFrame:
    """B2: assembly_id, code: the user's prefix, else the species list's code, else three letters of each of the last two words of the
    species (six of the genus before `sp.`), in capitals; codes that several assemblies share get a number, by assembly_id.

    `assemblies` (assembly_id, species, user_code, species_code).
    """
    words = F.split(F.trim("species"), r"\s+")
    last, first = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
    short = F.when(last == "sp.", F.substring(first, 1, 6)).otherwise(F.concat(F.substring(F.coalesce(first, F.lit("")), 1, 3), F.substring(last, 1, 3)))
    base = assemblies.select("assembly_id", F.upper(F.coalesce("user_code", "species_code", short)).alias("_c"))
    same = Window.partitionBy("_c")
    number = F.when(F.count("*").over(same) > 1, F.row_number().over(same.orderBy("assembly_id")).cast("string")).otherwise("")
    return base.select("assembly_id", F.concat("_c", number).alias("code"))


def collection_date(c: Column) -> Column:
    """Struct of year, month, day (null where unknown) of `2010-05-03`, `2010-05`, `2010`, `03-May-2010`, `May-2010`."""
    part = lambda pattern, i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    iso, named = r"^(\d{4})(?:-(\d{1,2})(?:-(\d{1,2}))?)?", r"^(?:(\d{1,2})-)?([A-Z][a-z]{2})[a-z]*-(\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(named, 2)).cast("int")
    year = F.coalesce(part(iso, 1), part(named, 3)).cast("int")
    return F.struct(year.alias("year"), F.coalesce(part(iso, 2).cast("int"), F.when(month > 0, month)).alias("month"), F.coalesce(part(iso, 3), part(named, 1)).cast("int").alias("day"))


def standard_term(c: Column, groups: Sequence[Sequence[str]], rule: str = "ins", default: str | None = None) -> Column:
    """The label (last entry) of the first group with a synonym inside the value (`ins`) or around it (`sin`); else `default`, else the value."""
    value = F.lower(c)
    out = F.lit(default) if default is not None else c
    for group in reversed(groups):
        hits = [value.contains(s.lower()) if rule == "ins" else F.contains(F.lit(s.lower()), value) for s in group]
        hit = hits[0]
        for h in hits[1:]:
            hit |= h
        out = F.when(hit, F.lit(group[-1])).otherwise(out)
    return out


def clinical_tags(c: Column, groups: Sequence[Sequence[str]]) -> Column:
    """First labels of the groups with a synonym in the text, comma-joined; null if there is none."""
    value = F.lower(c)
    tags = [F.when(F.array_contains(F.transform(F.array(*[F.lit(s.lower()) for s in g]), lambda s: F.contains(value, s)), True), F.lit(g[0])) for g in groups]
    return F.nullif(F.array_join(F.array_compact(F.array(*tags)), ","), F.lit(""))


def explode_cross_references(df: DataFrame, key: str, column: str, without: Sequence[str] = ("Assembly",)) -> DataFrame:
    """Key, db, id from text `db: x, y; db2: z`."""
    dbs = df.select(key, F.explode(F.split(column, r";\s*")).alias("_d")).select(key, F.trim(F.substring_index("_d", ":", 1)).alias("db"), F.regexp_extract("_d", r":\s*(.*)$", 1).alias("_i"))
    return dbs.where(~F.col("db").isin(*without)).select(key, "db", F.explode(F.split("_i", r",\s*")).alias("id")).where("id <> ''")


def cross_references(df: DataFrame, key: str, column: str, pubmed: str, added: DataFrame | None = None) -> DataFrame:
    """Key, db, id of the cross-references in `column`, of comma-separated PubMed ids, and of rows added by hand (key, db, id)."""
    out = explode_cross_references(df, key, column)
    ids = df.select(key, F.lit("PubMed").alias("db"), F.explode(F.split(pubmed, ",")).alias("id")).withColumn("id", F.trim("id")).where("id <> ''")
    return out.unionByName(ids) if added is None else out.unionByName(ids).unionByName(added.select(key, "db", "id"))


def replicon_type(attributes: Column, mol_type: Column) -> Column:
    """The attribute `genome`, else chromosome or plasmid if flagged, else the first word of the kind of molecule."""
    kind = F.coalesce(attributes["genome"], F.when(attributes["chromosome"].isNotNull(), "chromosome").when(attributes["plasmid-name"].isNotNull(), "plasmid"), F.substring_index(mol_type, " ", 1))
    return F.when(kind == "ANONYMOUS", "chromosome").otherwise(kind)


def clean_product(c: Column) -> Column:
    """Commas and semicolons written as percent codes."""
    return F.replace(F.replace(c, F.lit("%2C"), F.lit(",")), F.lit("%3B"), F.lit(";"))


def apply_overrides(df: DataFrame, rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Hand-made values (key, field, value) in place of given ones, without quotes; a `note` is appended instead."""
    wide = rows.withColumn("value", F.regexp_replace("value", "[\"']", "")).groupBy(key).pivot("field", list(fields)).agg(F.max("value"))
    wide = wide.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields])
    new = {f: F.concat_ws("; ", f, f"_new_{f}") if f == "note" else F.coalesce(f"_new_{f}", f) for f in fields}
    return df.join(wide, key, "left").withColumns(new).select(*df.columns)


def is_lab_strain(fields: Sequence[Column], species: Column, strain: Column) -> Column:
    """Whether a field speaks of a laboratory, or the strain is one of the well-known ones of its species."""
    named = F.concat_ws(" ", *fields).rlike("(?i)laborator|lab strain")
    return named | (species.eqNullSafe(F.lit("Escherichia coli")) & F.coalesce(strain.rlike(r"K-?12|BL21|DE3"), F.lit(False)))


def min_genomes(text: str, n: int) -> int:
    """A whole number is a count, a fraction a share of n."""
    return int(text) if text.isdigit() else int(float(text) * n)


def families_matching(df: DataFrame, pattern: str = "transposase") -> DataFrame:
    """Families with a product that matches, whatever the case."""
    return df.where(F.col("product").rlike(f"(?i){pattern}")).select("gene_family_id").distinct()


def find_families(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Term, gene_family_id: the family of that id, else all families with a product that holds the term; a term found nowhere has no row.

    `df` (gene_family_id, product). The terms are a user's list and part of the plan, so that `df` is read without a join on text.
    """
    wanted = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    by_id = df.where(F.col("gene_family_id").cast("string").isin(list(terms))).select(F.col("gene_family_id").cast("string").alias("term"), "gene_family_id").distinct()
    by_product = df.where("gene_family_id IS NOT NULL").select(F.explode(F.filter(wanted, lambda t: F.contains(F.col("product"), t))).alias("term"), "gene_family_id").distinct()
    return by_id.unionByName(by_product.join(by_id.select("term").distinct(), "term", "left_anti"))


def organism_label(organism: Column, strain: Column) -> Column:
    """Organism with ` str. ` and the strain, unless the name ends with it; brackets go."""
    name = F.translate(organism, "[]()", "")
    return F.when(strain.isNull() | F.endswith(name, strain), name).otherwise(F.concat_ws(" str. ", name, strain))


def tree_label(organism: Column, strain: Column, code: Column) -> Column:
    """The label with `_` for punctuation and blanks, and the code behind it."""
    return F.concat_ws("__", F.regexp_replace(organism_label(organism, strain), r"[\s.,:;()\[\]'/]+", "_"), code)


def label_prefix(c: Column, separator: str = "_") -> Column:
    """What stands before the separator."""
    return F.substring_index(c, separator, 1)


def cds_family_id(c: Column, old: str, new: str) -> Column:
    """A gene family's id from a protein family's, by its prefix."""
    return F.when(F.startswith(c, F.lit(old)), F.concat(F.lit(new), F.substring(c, F.lit(len(old) + 1), F.length(c)))).otherwise(c)


def explode_events(nodes: DataFrame) -> DataFrame:
    """Node, place, event_type, don_branch, rec_branch from labels such as `.T@a->b.D@c.d` (a bare name is a speciation). `nodes` (node, label)."""
    steps = nodes.select("node", F.posexplode(F.filter(F.split("label", r"\."), lambda x: x != "")).alias("place", "_e"))
    kind = F.when(F.col("_e").rlike("^[DT]@"), F.substring("_e", 1, 1)).otherwise("S")
    at = F.regexp_replace("_e", "^[DT]@", "")
    return steps.select("node", "place", kind.alias("event_type"), F.when(kind == "T", F.substring_index(at, "->", 1)).alias("don_branch"), F.substring_index(at, "->", -1).alias("rec_branch"))
