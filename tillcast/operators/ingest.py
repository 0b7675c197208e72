"""Raw tables to staging rows (B1-B8, C1, D25), driven by the star schema: the type of a staging
column says how its raw text is read, so a column added to the schema needs no code here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.scalars import first_char, normalise_name, parse_date, to_bool
from tillcast.schemas import DIM_STORE, FACT, KEYS, RAW_FEATURES, RAW_STORES, RAW_TRAIN

#: Raw names that differ from the schema's.
RAW_NAMES = {"store_id": "store", "dept_id": "dept", "week_date": "date", "store_type": "type", "store_size": "size"}
READERS = {T.IntegerType: lambda c: c.try_cast("int"), T.DecimalType: lambda c: c.try_cast("double"),
           T.DateType: parse_date, T.BooleanType: to_bool, T.StringType: first_char}
FACT_COLUMNS = FACT.fieldNames()
FEATURE_NUMERIC = [f.name for f in FACT.fields if isinstance(f.dataType, T.DecimalType) and f.name != "weekly_sales"]


def staged(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` that ``raw`` has, read by their types; what does not parse is null.
    Numbers stay doubles in staging: the range check (J5) sees them before the fact's decimals do."""
    have = set(raw.columns)
    named = ((f, RAW_NAMES.get(f.name, f.name)) for f in schema.fields)
    return raw.select(*[READERS[type(f.dataType)](F.col(n)).alias(f.name) for f, n in named if n in have])


def accepted_and_refused(lines: DataFrame, raw: T.StructType, table: T.StructType, keys=(), col: str = "value"):
    """A1 / B8 on text lines: (rows, refused) of a headered CSV, read by the all-string schema ``raw``.

    A line with too few or too many fields is no row: read as one, it would turn into nulls without a
    word.  Nor is a blank one, or one whose ``keys`` are absent or have no reading as the types that
    ``table`` gives them.  Refused lines keep their text and all their reasons.  The header may stand
    in any file; other fields without a reading become null in the staging rows, as before."""
    names = {normalise_name(f.name): f.name for f in raw.fields}
    corrupt = "corrupt_record"
    schema = ", ".join([*[f"`{n}` string" for n in names], f"{corrupt} string"])
    header = F.lower(F.regexp_replace(F.col(col), r"[\s\"]", "")) == ",".join(n.replace("_", "") for n in names)
    header = header | (F.lower(F.regexp_replace(F.col(col), r"[\s\"]", "")) == ",".join(names))
    blank = F.trim(col) == ""
    read = F.from_csv(F.col(col), F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    fields = lines.where(~F.coalesce(header, F.lit(False))).select(F.coalesce(col, F.lit("")).alias(col)).select(col, read.alias("_f"))
    fields = fields.select(col, "_f.*")
    whole = ~blank & F.col(corrupt).isNull()
    reasons = [F.when(blank, F.lit("blank line")), F.when(~blank & F.col(corrupt).isNotNull(), F.lit("wrong number of fields"))]
    for key in keys:
        name, kind = RAW_NAMES.get(key, key), type(table[key].dataType)
        text = F.trim(F.coalesce(name, F.lit("")))
        reasons += [F.when(whole & (text == ""), F.lit(f"{name} missing")),
                    F.when(whole & (text != "") & READERS[kind](F.col(name)).isNull(), F.lit(f"{name} unreadable"))]
    judged = fields.withColumn("reasons", F.filter(F.array(*reasons), lambda r: r.isNotNull()))
    return (judged.where(F.size("reasons") == 0).select(*names),
            judged.where(F.size("reasons") > 0).select(F.col(col).alias("line"), "reasons"))


def ingest_lines(stores: DataFrame, features: DataFrame, train: DataFrame):
    """Text lines of the three raw tables -> (their staging frames, refused lines with their table)."""
    tables = {"stores": (stores, RAW_STORES, DIM_STORE, ["store_id"]), "features": (features, RAW_FEATURES, FACT, ["store_id", "week_date"]),
              "train": (train, RAW_TRAIN, FACT, KEYS)}
    rows, refused = [], None
    for name, args in tables.items():
        good, bad = accepted_and_refused(*args)
        rows.append(good)
        bad = bad.select(F.lit(name).alias("table"), "*")
        refused = bad if refused is None else refused.unionByName(bad)
    return ingest(*rows), refused


def typed_stores(raw: DataFrame) -> DataFrame:
    """B2 + D25: one row per store id; the duplicate kept is the smallest (type, size) (nulls
    first), so the pick does not depend on file order.  An aggregate, not a window: a store
    repeated in a third of the file is combined inside each task before the shuffle."""
    rest = [c for c in DIM_STORE.fieldNames() if c != "store_id"]
    return (staged(raw, DIM_STORE).groupBy("store_id").agg(F.min(F.struct(*rest)).alias("_s"))
            .select("store_id", "_s.*"))


def typed_features(raw: DataFrame) -> DataFrame:
    """Store, date, flag and the numeric covariates."""
    return staged(raw, FACT)


def typed_train(raw: DataFrame) -> DataFrame:
    """Store, department, date, sales and flag."""
    return staged(raw, FACT)


def departments(train: DataFrame) -> DataFrame:
    """Distinct department ids."""
    return train.select("dept_id").distinct()


def fact_rows(train: DataFrame, features: DataFrame) -> DataFrame:
    """C1 + B8: left join on what both tables have (store, week, holiday flag) -- a null flag
    never matches and repeated feature rows fan out -- without rows of a null key."""
    shared = [c for c in train.columns if c in features.columns]
    return train.dropna(subset=KEYS).join(features, shared, "left").select(*FACT_COLUMNS)


def ingest(raw_stores: DataFrame, raw_features: DataFrame, raw_train: DataFrame):
    """(dim_store_stg, dim_dept_stg, fact_stg) from the three raw frames."""
    train = typed_train(raw_train)
    return typed_stores(raw_stores), departments(train), fact_rows(train, typed_features(raw_features))
