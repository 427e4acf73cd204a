"""Text and table sources: FASTA, protein and peptide CSV, microscope metadata, classifier files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PROTEIN_COLUMNS = ("Name", "UniprotAC", "Sequence", "Abundance", "POI", "PTM")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence) of plain or gzipped FASTA: records are split at line-leading `>`; text before the first is an error."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "\r", "").alias("v"), F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    # Only a file's first record keeps its own mark; records begin where the separator was.
    first = F.row_number().over(Window.partitionBy("f").orderBy("i")) == 1
    marked = records.withColumn("first", first).filter("trim(v) <> ''")
    body = F.when(F.col("first") & ~F.col("v").startswith(">"), F.raise_error("text before the first header").cast("string")).otherwise(F.regexp_replace("v", "^>", ""))
    cut = marked.select(body.alias("v"))
    return cut.select(F.trim(F.substring_index("v", "\n", 1)).alias("header"), F.when(F.instr("v", "\n") > 0, F.regexp_replace(F.expr("substring(v, instr(v, '\n') + 1)"), r"\s", "")).otherwise("").alias("sequence"))


def read_proteins(spark: SparkSession, path: str, pois: list[str] | None = None) -> DataFrame:
    """(order, name, sequence, abundance, is_poi, ptm_locs) of a protein CSV; unknown columns go, missing ones are null.

    Nameless proteins are called Protein_0000 and so on in file order; those in `pois` come first, in the order given.
    """
    raw = spark.read.csv(path, header=True)
    known = raw.select(*(F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in PROTEIN_COLUMNS), F.monotonically_increasing_id().alias("_i"))
    number = F.row_number().over(Window.orderBy("_i")) - 1  # a protein list is small
    named = known.withColumn("name", F.coalesce("Name", "UniprotAC", F.concat(F.lit("Protein_"), F.lpad(number.cast("string"), 4, "0"))))
    truth = F.lower(F.coalesce(F.col("POI"), F.lit("0"))).isin("1", "true", "yes", "y", "t")
    place = F.coalesce(*[F.when(F.col("name") == n, F.lit(i)) for i, n in enumerate(pois)], F.lit(len(pois))) if pois else F.lit(0)
    out = named.withColumn("is_poi", truth if not pois else F.col("name").isin(*pois)).withColumn("order", F.row_number().over(Window.orderBy(place, "_i")) - 1)
    return out.select("order", "name", F.col("Sequence").alias("sequence"), F.coalesce(F.expr("try_cast(Abundance as double)"), F.lit(1.0)).alias("abundance"), "is_poi", F.coalesce("PTM", F.lit("")).alias("ptm_locs"))


def read_peptides(spark: SparkSession, sequences: str, names: str, pois: list[str]) -> DataFrame:
    """(pep_i, name, sequence, is_poi) of two headerless CSVs: (sequence, pep_i) and (name, pep_i)."""
    seqs = spark.read.csv(sequences, schema="sequence string, pep_i long")
    return spark.read.csv(names, schema="name string, pep_i long").join(seqs, "pep_i").withColumn("is_poi", F.col("name").isin(*pois) if pois else F.lit(False))


def read_scope_metadata(spark: SparkSession, path: str, encoding: str = "UTF-16") -> DataFrame:
    """(path, keys, value): tab-separated dotted keys and values of a microscope's metadata file."""
    files = spark.read.format("binaryFile").load(path)
    lines = files.select("path", F.explode(F.split(F.decode("content", encoding), r"\r?\n|\\n")).alias("line")).filter("trim(line) <> ''")
    cells = F.split("line", r"\t|\\t", 2)
    return lines.select("path", F.split(F.trim(F.get(cells, F.lit(0))), r"\.").alias("keys"), F.trim(F.coalesce(F.get(cells, F.lit(1)), F.lit(""))).alias("value"))


def write_radmat(radmats: DataFrame, path: str, values: str = "radmat") -> None:
    """Headerless tab-separated rows, channels side by side, in the order of row_i."""
    width = F.size(values)
    n = radmats.select(F.max(width)).first()[0] or 0
    radmats.orderBy("row_i").select(*(F.get(values, F.lit(i)).alias(f"v{i}") for i in range(n))).write.csv(path, sep="\t", header=False)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(row_i, pred_i, score) of an external classifier's CSV; its classes count from 0, ours from 1."""
    return spark.read.csv(path, schema="row_i long, pred_i long, score double").withColumn("pred_i", F.col("pred_i") + 1)


def fit_value(text: Column, name: str) -> Column:
    """A named number in a fitter's printed report."""
    return F.nullif(F.regexp_extract(text, rf"\b{name}\s*[:=]\s*(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)", 1), F.lit("")).cast("double")


def read_bootstrap(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table of fitted parameters, a row a bootstrap replicate; without a schema types are as they look, which takes a pass of its own."""
    return spark.read.csv(path, header=True, schema=schema, inferSchema=schema is None)


def write_grid(rows: DataFrame, path: str, sep: str = ",") -> None:
    """Rows as a text grid, array columns as `;`-joined lists."""
    flat = [F.array_join(F.transform(c, lambda x: x.cast("string")), ";", "").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.csv(path, sep=sep, header=True)


def write_dye_sequences(seqs: DataFrame, path: str, n_channels: int) -> None:
    """An external classifier's dye sequences: tab-separated (sequence, peptides, first peptide) under lines of the numbers of channels and rows."""
    rows = seqs.filter("dyeseq <> ''").groupBy("dyeseq").agg(F.count("*").alias("n"), F.min("pep_i").alias("pep_i"))
    head = rows.agg(F.concat(F.lit(f"{n_channels}\n"), F.count("*").cast("string")).alias("value"))
    body = rows.select(F.concat_ws("\t", "dyeseq", F.col("n").cast("string"), F.col("pep_i").cast("string")).alias("value"), "pep_i")
    # One file with its head first, as the classifier reads it: rows are distinct patterns.
    head.withColumn("pep_i", F.lit(-1).cast("long")).unionByName(body.withColumn("pep_i", F.col("pep_i").cast("long"))).coalesce(1).sortWithinPartitions("pep_i").select("value").write.text(path)


def read_dye_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(dyeseq, n, pep_i) of such a file."""
    cells = F.split("value", "\t")
    return spark.read.text(path).filter(F.size(cells) == 3).select(F.get(cells, F.lit(0)).alias("dyeseq"), F.get(cells, F.lit(1)).cast("long").alias("n"), F.get(cells, F.lit(2)).cast("long").alias("pep_i"))
