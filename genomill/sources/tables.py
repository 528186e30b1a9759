"""Readers of tables and text formats, and sinks. Each gives a DataFrame; parsing is done by built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.operators.sequences import number_rows


def load_tsv(spark: SparkSession, path: str, types: Mapping[str, str], keep_empty: Sequence[str] = ()) -> DataFrame:
    """A1: a table with a header, its columns taken by name and cast; empty values are null but in `keep_empty`."""
    raw = spark.read.csv(path, sep="\t", header=True, nullValue="\u0000", emptyValue="", quote="")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) if c in keep_empty else F.when(F.col(c) != "", F.col(c))
    return raw.select(*[empty(c).try_cast(t).alias(c) for c, t in types.items()])


def project_fields(df: DataFrame, names: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """A2: the named columns of a wide table; a column that isn't there may go by its alias."""
    aliases = aliases or {}
    return df.select(*[F.col(n if n in df.columns else aliases[n]).alias(n) for n in names])


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """A4: file, id, tags (`[key=value]` of the header), seq, of every record."""
    records = spark.read.text(path, lineSep="\n>").select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", r"^>|\r", "").alias("_r")).where("trim(_r) <> ''")
    head = F.substring_index("_r", "\n", 1)
    body = F.expr("substring(_r, length(substring_index(_r, '\n', 1)) + 1)")
    tags = F.map_from_arrays(F.regexp_extract_all(head, F.lit(r"\[(\w+)=([^\]]*)\]"), 1), F.regexp_extract_all(head, F.lit(r"\[(\w+)=([^\]]*)\]"), 2))
    return records.select("file", F.regexp_extract(head, r"^(\S+)", 1).alias("id"), tags.alias("tags"), F.regexp_replace(body, r"\s", "").alias("seq"))


def taxon_names(names: DataFrame, merged: DataFrame, taxa: DataFrame) -> DataFrame:
    """Scientific name of each taxid, by way of the id that it was merged into. `names` (taxid, name, kind), `merged` (old, new)."""
    now = taxa.select("taxid").join(merged.select(F.col("old").alias("taxid"), "new"), "taxid", "left").withColumn("_id", F.coalesce("new", "taxid"))
    known = names.where("kind = 'scientific name'").select(F.col("taxid").alias("_id"), "name")
    return now.join(known, "_id", "left").select("taxid", F.col("_id").alias("current_taxid"), "name")


def read_species_codes(lines: DataFrame) -> DataFrame:
    """Code, taxid from a fixed-format list (`CODE  K  taxid: N=name`); lines that begin with a blank or `<` are left out."""
    pattern = r"^([A-Z0-9]{3,5})\s+\S\s+(\d+):"
    return lines.where(~F.col("value").rlike("^[ <]") & F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("code"), F.regexp_extract("value", pattern, 2).cast("long").alias("taxid"))


def split_annotations(rows: DataFrame, loaded: DataFrame | None = None, version: str = "", known: DataFrame | None = None) -> dict[str, DataFrame]:
    """A wide annotation table as `proteins`, `hits`, `interpro`, `go` and `pathways`; proteins already loaded in this version are left out.

    `rows` (place, nr_protein_id, md5_digest, seq_length, interpro_id, description, go_terms, pathways); terms are parted by `|`, a
    pathway into database and id by `: `. What a domain means is taken from the first row that names it, by `place` in the files, and
    so is a protein's digest; domains of `known` (interpro_id) are described already.
    """
    if loaded is not None:
        rows = rows.join(loaded.where(F.col("version") == version).select("nr_protein_id"), "nr_protein_id", "left_anti")
    first = lambda df, key, *columns: df.groupBy(key).agg(F.min_by(F.struct(*columns), "place").alias("_r")).select(key, "_r.*")
    terms = first(rows.where("interpro_id IS NOT NULL"), "interpro_id", "description", "go_terms", "pathways")
    if known is not None:
        terms = terms.join(known.select("interpro_id"), "interpro_id", "left_anti")
    parts = lambda c: F.explode(F.split(F.col(c), r"\|"))
    path = terms.where("pathways <> ''").select("interpro_id", parts("pathways").alias("_p")).select("interpro_id", F.substring_index("_p", ": ", 1).alias("db"), F.substring_index("_p", ": ", -1).alias("pathway_id"))
    return {
        "proteins": first(rows, "nr_protein_id", "md5_digest", "seq_length"),
        "hits": rows.select("nr_protein_id", "interpro_id", F.lit(version).alias("version")).distinct(),
        "interpro": terms,
        "go": terms.where("go_terms <> ''").select("interpro_id", parts("go_terms").alias("go_id")).distinct(),
        "pathways": path.distinct(),
    }


def _by_family(spark: SparkSession, path: str, suffix: str, schema: str) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", schema=schema)
    return raw.select(F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\Q{suffix}\E$", 1).alias("gene_family_id"), *raw.columns).withColumn("label", F.trim("label"))


def load_event_lineages(spark: SparkSession, path: str, suffix: str, reconciliation: int) -> DataFrame:
    """Label, event_id, freq from a file per family, whose name is family + `suffix`."""
    return _by_family(spark, path, suffix, "label string, event_id int, freq int").withColumn("reconciliation_id", F.lit(reconciliation))


def load_species_tree(spark: SparkSession, path: str) -> DataFrame:
    """branch_id, parent_branch_id, branch_name, is_tip of a dump without header; an empty parent is the root's."""
    return spark.read.csv(path, sep="\t", schema="branch_id int, parent_branch_id int, branch_name string, is_tip int").withColumn("is_tip", F.col("is_tip") != 0)


def load_tree_events(spark: SparkSession, path: str) -> DataFrame:
    """event_id, event_type, don_branch_id, rec_branch_id of a dump without header; empty branches are null."""
    return spark.read.csv(path, sep="\t", schema="event_id int, event_type string, don_branch_id int, rec_branch_id int")


def load_groups(spark: SparkSession, path: str, suffix: str, collection: int) -> DataFrame:
    """A10: label, og_id from a file per family, whose name is family + `suffix`; blanks around labels go."""
    return _by_family(spark, path, suffix, "label string, og_id int").withColumn("ortholog_col_id", F.lit(collection))


def read_clades(lines: DataFrame) -> DataFrame:
    """Clade, cds_code from lines `constraint cladeN -1 = a b c;`."""
    pattern = r"^\s*constraint\s+(\S+)\s+-1\s*=\s*([^;]*);"
    return lines.where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("clade"), F.explode(F.split(F.trim(F.regexp_extract("value", pattern, 2)), r"\s+")).alias("cds_code"))


def read_lists(lines: DataFrame) -> DataFrame:
    """Cluster, place, member from lines `id: a<TAB>b<TAB>c`."""
    pattern = r"^([^:]+):\s*(.*)$"
    return lines.where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("cluster"), F.posexplode(F.split(F.regexp_extract("value", pattern, 2), "\t")).alias("place", "member")).where("member <> ''")


def lists_to_groups(lists: DataFrame, families: DataFrame, collection: int, skip: str) -> DataFrame:
    """Clusters as groups numbered within each family; the family `skip` is left out. `families` (member, gene_family_id)."""
    named = lists.select("cluster", "member").distinct().join(families, "member").where(F.col("gene_family_id") != skip)
    return named.select("gene_family_id", "member", F.dense_rank().over(Window.partitionBy("gene_family_id").orderBy("cluster")).alias("og_id"), F.lit(collection).alias("ortholog_col_id"))


def read_triangle(lines: DataFrame) -> DataFrame:
    """A, b, distance in both directions, from rows (row, value) of a lower triangle: a label, then distances to the rows before it."""
    cells = lines.select("row", F.split("value", "\t").alias("_c")).select("row", F.regexp_replace(F.col("_c")[0], r"^.*/|\.(fa|fna|fasta)$", "").alias("a"), F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(0))).alias("_d"))
    far = cells.select("a", F.posexplode("_d").alias("_row", "_v")).select("a", F.col("_row").alias("row"), F.col("_v").cast("double").alias("distance"))
    pairs = far.join(cells.select("row", F.col("a").alias("b")), "row").select("a", "b", "distance")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster, place, seq_id from FASTA records in blocks parted by a zero byte; clusters are numbered in the order of the file."""
    blocks = spark.read.text(path, lineSep="\x00").where("trim(value) <> ''").select(F.monotonically_increasing_id().alias("_at"), F.regexp_extract_all("value", F.lit(r"(?m)^>(\S+)"), 1).alias("_ids"))
    return number_rows(blocks, ["_at"], "cluster").select("cluster", F.posexplode("_ids").alias("place", "seq_id"))


def strain_errors(strains: DataFrame) -> DataFrame:
    """assembly_id, error of each broken rule: no empty field, no `-` or `_` in prefixes, no blank or slash in strains, prefixes differ."""
    wrong = [strains.where(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").select("assembly_id", F.lit(f"empty {c}").alias("error")) for c in strains.columns]
    wrong.append(strains.where(F.col("locus_tag_prefix").rlike("[-_]")).select("assembly_id", F.lit("character in locus_tag_prefix").alias("error")))
    wrong.append(strains.where(F.col("strain").rlike(r"[ \\/]")).select("assembly_id", F.lit("character in strain").alias("error")))
    often = strains.groupBy("locus_tag_prefix").agg(F.count("*").alias("_n")).where("_n > 1")
    wrong.append(strains.join(often, "locus_tag_prefix").select("assembly_id", F.lit("repeated locus_tag_prefix").alias("error")))
    return reduce(DataFrame.unionByName, wrong)


def write_scores(scores: DataFrame, path: str, rows_a_file: int = 40_000_000) -> None:
    """id1, id2 and the score with six places, in files of a bounded size."""
    scores.select("rlocds_id_1", "rlocds_id_2", F.format_string("%f", "score").alias("score")).write.option("maxRecordsPerFile", rows_a_file).option("sep", "\t").mode("overwrite").csv(path)


def replace_collection(df: DataFrame, path: str, column: str) -> None:
    """Replaces the collections that `df` holds in a Parquet table parted by `column`, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def count_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines of each file of a glob."""
    return spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))


def dump_codes(genomes: DataFrame) -> DataFrame:
    """Identifiers of coding sequences, without `lcl|`, and their codes."""
    return genomes.select(F.regexp_replace("genbank_cds_id", r"lcl\|", "").alias("genbank_cds_id"), "cds_code")
