"""Table sources: vendor map, prior filings, earnings sheets, interest, review tables, stage tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.fixed_values import EARNINGS_HEADERS
from ledgerloom.functions.dates import cell_date, flexible_date
from ledgerloom.functions.money import parse_money
from ledgerloom.functions.text import blank_to_null, strip
from ledgerloom.scale import computed_once
from ledgerloom.schemas import STR_EARNING, VENDOR_MAP


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A stored table, or None where nothing is stored."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stage_path(root: str, name: str, year: int) -> str:
    """Where one year's stage table lives; ``root`` may contain ``{year}``."""
    return f"{root.format(year=year).rstrip('/')}/{name}"


def map_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored versions of a vendor map, one row per save; None before the first.

    A version is a whole map or, if not ``whole``, the vendors that differ from the version before it.
    """
    return _read(spark, f"{path.rstrip('/')}/pointer", "number LONG, name STRING, whole BOOLEAN")


def map_changes(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of the last whole version and of all after it: few, as every ``sinks.COMPACT`` changes make a whole one."""
    known = map_versions(spark, path)
    if known is None:
        return []
    whole = known.filter(F.coalesce("whole", F.lit(True))).agg(F.max("number").alias("first"))
    return [tuple(r) for r in known.join(whole, F.col("number") >= F.col("first")).orderBy("number").select("number", "name").collect()]


def load_vendor_map(spark: SparkSession, path: str) -> DataFrame:
    """The learned map, every vendor as the newest version has it; empty when nothing was saved yet."""
    versions = map_changes(spark, path)
    if not versions:
        return spark.createDataFrame([], VENDOR_MAP)
    stored = lambda name: spark.read.schema(f"{VENDOR_MAP}, gone BOOLEAN").parquet(f"{path.rstrip('/')}/versions/{name}")
    if len(versions) == 1:
        return stored(versions[0][1]).drop("gone")
    log = reduce(DataFrame.unionByName, [stored(name).withColumn("number", F.lit(number)) for number, name in versions])
    newest = log.groupBy("vendor").agg(F.max_by(F.struct(*[c for c in log.columns if c not in ("vendor", "number")]), "number").alias("v"))
    kept = newest.select("vendor", "v.*").filter("gone IS NULL OR NOT gone")
    return kept.select(*[c for c in log.columns if c not in ("number", "gone")])


def read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage table with its declared schema; empty when the stage has not run."""
    found = _read(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def find_column(columns: Sequence[str], alternatives: Sequence[str]) -> str | None:
    """First alternative that is a column, ignoring case and outer blanks."""
    by_lower = {c.strip().lower(): c for c in reversed(list(columns))}
    return next((by_lower[a] for a in alternatives if a in by_lower), None)


def _column(df: DataFrame, alternatives: Sequence[str]) -> Column:
    name = find_column(df.columns, alternatives)
    return F.lit(None).cast("string") if name is None else F.col(f"`{name}`").cast("string")


def prior_entries(sheets: Sequence[DataFrame]) -> DataFrame | None:
    """Prior filing rows ``(date, description, amount, category)`` from text sheets.

    Sheets that lack one of the four columns are skipped, rows with a missing value are dropped. None when no
    sheet qualifies.
    """
    wanted = ("date", "description", "amount", "category")
    out: DataFrame | None = None
    for sheet in sheets:
        if any(find_column(sheet.columns, (w,)) is None for w in wanted):
            continue
        part = sheet.select(
            cell_date(_column(sheet, ("date",))).alias("date"),
            strip(_column(sheet, ("description",))).alias("description"),
            strip(_column(sheet, ("amount",))).try_cast("decimal(18,2)").alias("amount"),
            strip(_column(sheet, ("category",))).alias("category"),
        ).dropna()
        out = part if out is None else out.unionByName(part)
    return out


def earnings_by_header(sheets: Mapping[str, DataFrame]) -> DataFrame | None:
    """Earnings of one text sheet per property, columns found by synonym; None when no sheet has payouts."""
    out: DataFrame | None = None
    for prop, sheet in sheets.items():
        if find_column(sheet.columns, EARNINGS_HEADERS["net_payout"]) is None:
            continue
        c = {field: _column(sheet, names) for field, names in EARNINGS_HEADERS.items()}
        part = sheet.select(
            F.lit(prop).alias("property"),
            cell_date(c["stay_start"]).alias("stay_start"),
            cell_date(c["stay_end"]).alias("stay_end"),
            F.coalesce(c["platform"], F.lit("")).alias("platform"),
            strip(c["gross"]).try_cast("decimal(18,2)").alias("gross"),
            strip(c["fees"]).try_cast("decimal(18,2)").alias("fees"),
            strip(c["net_payout"]).try_cast("decimal(18,2)").alias("net_payout"),
        ).filter("net_payout IS NOT NULL")
        out = part if out is None else out.unionByName(part)
    return out


def earnings_by_position(rows: DataFrame, *, year: int) -> DataFrame:
    """``rows(property, cells ARRAY<STRING>)``: start, end, payout, source.

    Rows with fewer than three cells, blank rows and rows without a readable payout (cancelled stays, repeated
    headers) are left out.
    """
    def cell(i: int) -> Column:
        return F.try_element_at("cells", F.lit(i))

    blank = F.coalesce(blank_to_null(cell(1)), blank_to_null(cell(2)), blank_to_null(cell(3))).isNull()
    return (
        computed_once(
            rows.filter((F.size("cells") >= 3) & ~blank),
            "property",
            flexible_date(cell(1), year).alias("stay_start"),
            flexible_date(cell(2), year).alias("stay_end"),
            F.coalesce(strip(cell(4)), F.lit("")).alias("platform"),
            F.lit(None).cast("decimal(18,2)").alias("gross"),
            F.lit(None).cast("decimal(18,2)").alias("fees"),
            parse_money(cell(3)).alias("net_payout"),
        )
        .filter("net_payout IS NOT NULL")
    )


def empty_earnings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STR_EARNING)


def interest_by_year(nested: DataFrame, *, year: int) -> DataFrame:
    """``nested(by_year MAP<INT, MAP<STRING, DECIMAL>>)`` -> ``(year, property, amount)`` of one year."""
    return (
        nested.select(F.explode("by_year").alias("year", "by_property"))
        .filter(F.col("year") == year)
        .select("year", F.explode("by_property").alias("property", "amount"))
    )


def read_review_rows(spark: SparkSession, root: str, name: str, year: int) -> DataFrame | None:
    """Review rows typed by people: ``<root>/<name>_<year>`` first, then ``<root>/<name>``."""
    own = _read(spark, f"{root}/{name}_{year}")
    return _read(spark, f"{root}/{name}") if own is None else own
