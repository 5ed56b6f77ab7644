"""The catalog: versioned dimensions, look-ups, key choice, schema differences, publication upkeep, admission checks."""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of the catalog's schemas, relations and prefixes, and of replica identities.
INTERNAL_SCHEMA, CATALOG_SCHEMA = "_timescaledb_internal", "_timescaledb_catalog"
HYPERTABLE_RELATION, CHUNK_RELATION = "hypertable", "chunk"
COMPRESSED_PREFIX, MATERIALIZED_PREFIX = "compress_", "_materialized_"
REPLICA_IDENTITIES = {"n": "nothing", "f": "full", "d": "default", "i": "index"}
PARTIALLY_COMPRESSED = 8


def canonical(schema: Column, name: Column) -> Column:
    return F.concat_ws(".", schema, name)


def relation_class(schema: Column, name: Column) -> Column:
    """Which handler a log row belongs to."""
    return F.when((schema == CATALOG_SCHEMA) & (name == HYPERTABLE_RELATION), "hypertable").when((schema == CATALOG_SCHEMA) & (name == CHUNK_RELATION), "chunk").when(schema.isin(INTERNAL_SCHEMA, CATALOG_SCHEMA), "internal").otherwise("vanilla")


def is_compressed(name: Column) -> Column:
    return name.startswith(COMPRESSED_PREFIX)


def is_partially_compressed(status: Column) -> Column:
    return status.bitwiseAND(PARTIALLY_COMPRESSED) == PARTIALLY_COMPRESSED


def is_continuous_aggregate(name: Column, view_schema: Column, view_name: Column) -> Column:
    return name.startswith(MATERIALIZED_PREFIX) & view_schema.isNotNull() & view_name.isNotNull()


def versions(changes: DataFrame, key: str, order: str = "lsn") -> DataFrame:
    """Catalog log rows (op, key, attributes, lsn) as a versioned dimension: each row holds from its lsn to the next one's; deletes end it."""
    w = Window.partitionBy(key).orderBy(order)
    return changes.withColumn("valid_from_lsn", F.col(order)).withColumn("valid_to_lsn", F.lead(order).over(w)).filter("op <> 'd'")


def as_of(log: DataFrame, dim: DataFrame, log_key: str, dim_key: str) -> DataFrame:
    """Each log row with the version of its table that holds at its position. An equi-join with a range, not a range join alone."""
    return log.join(dim, (F.col(log_key) == F.col(dim_key)) & (F.col("lsn") >= F.col("valid_from_lsn")) & (F.col("valid_to_lsn").isNull() | (F.col("lsn") < F.col("valid_to_lsn"))))


def missing(known: DataFrame, published: DataFrame, on: str) -> DataFrame:
    return known.join(published, on, "left_anti")


def still_existing(state: DataFrame, current: DataFrame, on: str) -> DataFrame:
    return state.join(current, on, "left_semi")


def key_columns(columns: DataFrame) -> DataFrame:
    """table_id, key: the primary key's columns by key_seq, or else the dimensions by dim_seq."""
    pick = lambda flag, seq: F.transform(F.array_sort(F.collect_list(F.when(F.col(flag), F.struct(F.col(seq).alias("s"), F.col("name").alias("n"))))), lambda x: x["n"])
    found = columns.groupBy("table_id").agg(pick("is_pk", "key_seq").alias("pk"), pick("is_dimension", "dim_seq").alias("dims"))
    return found.select("table_id", F.when(F.size("pk") > 0, F.col("pk")).otherwise(F.col("dims")).alias("key"))


def identity_issues(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Tables whose replica identity gives updates and deletes no key: (table, kind, issue)."""
    has = columns.groupBy("table_id").agg(F.max("is_pk").alias("pk"), F.max("is_replica_ident").alias("ri"))
    found = tables.join(has, tables["id"] == has["table_id"], "left")
    issue = F.when((F.col("replica_identity") == "i") & ~F.coalesce("ri", F.lit(False)), "index").when(~F.coalesce("pk", F.lit(False)), "default")
    return found.filter((F.col("replica_identity") != "f") & ~F.col("is_cagg")).select(canonical(F.col("schema_name"), F.col("table_name")).alias("table"), "kind", issue.alias("issue")).filter("issue IS NOT NULL")


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: str
    modifiers: int = -1
    nullable: bool = False
    is_pk: bool = False
    default: str | None = None

    @property
    def shape(self) -> tuple:
        return self.type, self.modifiers, self.nullable, self.is_pk, self.default


def schema_diff(old: list[ColumnDef], new: list[ColumnDef]) -> dict[str, str]:
    """added, dropped, renamed (by its new name; the last column by its old one) and changed columns."""
    out: dict[str, str] = {}
    for _, i, i2, j, j2 in (op for op in SequenceMatcher(a=old, b=new, autojunk=False).get_opcodes() if op[0] != "equal"):
        for a, b in zip(old[i:i2], new[j:j2], strict=False):
            if a.shape == b.shape:
                out[a.name if b is new[-1] else b.name] = f"name:{a.name}=>{b.name}"
            else:
                pairs = [("name", a.name, b.name), ("type", a.type, b.type), ("modifiers", a.modifiers, b.modifiers), ("nullable", a.nullable, b.nullable), ("pk", a.is_pk, b.is_pk), ("default", a.default, b.default)]
                out[a.name] = ",".join(f"{k}:{x}=>{y}" for k, x, y in pairs if x != y)
        n = min(i2 - i, j2 - j)
        out |= {a.name: f"dropped: {a}" for a in old[i + n : i2]}
        out |= {b.name: f"added: {b}" for b in new[j + n : j2]}
    return out


def schema_diff_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """The set part of the difference, distributed: (table_id, name, change)."""
    o, n = old.select("table_id", "name", F.col("type").alias("old_type")), new.select("table_id", "name", F.col("type").alias("new_type"))
    change = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "dropped").when(F.col("old_type") != F.col("new_type"), "changed")
    return o.join(n, ["table_id", "name"], "full_outer").withColumn("change", change).filter("change IS NOT NULL").select("table_id", "name", "change")


def admitted(postgres: int, extension: int, wal_level: str) -> list[str]:
    """What keeps a server from being followed: versions as 10000 * major + minor."""
    return [m for bad, m in ((postgres < 130000, "PostgreSQL 13 is the least"), (extension < 20010, "extension 2.10 is the least"), (wal_level != "logical", "wal_level must be logical")) if bad]
