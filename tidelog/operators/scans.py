"""Scans of the database's catalog tables (namespaces, classes, attributes, types, hypertables, chunks).

The catalog comes as DataFrames with the column names of the database's own views, from Parquet or
JDBC alike. It is small beside the log, but nothing here relies on that: all look-ups are equi-joins
on the catalog's keys, so Spark broadcasts what is small and shuffles what is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.catalog import canonical, relation_class

SYSTEM_PREFIX = "_timescaledb_"  #: Fixed value: the start of the extension's own schemas


def with_class(tables: DataFrame, namespaces: DataFrame, classes: DataFrame, schema: str, name: str) -> DataFrame:
    """tables with class_oid and relreplident of the class of that schema and name; null where there is none."""
    spaces = namespaces.select(F.col("oid").alias("_ns"), F.col("nspname").alias("_nsp"))
    rel = classes.select(F.col("oid").alias("class_oid"), F.col("relname").alias("_rel"), F.col("relnamespace").alias("_of"), "relreplident")
    found = tables.join(spaces, F.col(schema) == F.col("_nsp"), "left").join(rel, (F.col(name) == F.col("_rel")) & (F.col("_ns") == F.col("_of")), "left")
    return found.drop("_ns", "_nsp", "_rel", "_of")


def hypertables(tables: DataFrame, caggs: DataFrame, namespaces: DataFrame, classes: DataFrame) -> DataFrame:
    """Hypertables with their continuous aggregate's view and their replica identity (both may be missing)."""
    views = caggs.select(F.col("mat_hypertable_id").alias("_mat"), "user_view_schema", "user_view_name")
    return with_class(tables.join(views, F.col("id") == F.col("_mat"), "left").drop("_mat"), namespaces, classes, "schema_name", "table_name").drop("class_oid")


def chunks(found: DataFrame, information: DataFrame) -> DataFrame:
    """Chunks with the start of their range, null for those that the information view does not list."""
    info = information.select(F.col("chunk_schema").alias("_cs"), F.col("chunk_name").alias("_cn"), "range_start")
    return found.join(info, (F.col("schema_name") == F.col("_cs")) & (F.col("table_name") == F.col("_cn")), "left").drop("_cs", "_cn")


def chunk_order() -> list[Column]:
    """Chunks of a hypertable together, uncompressed ones first, by their range."""
    return [F.col("hypertable_id").asc(), F.col("compressed_chunk_id").asc_nulls_first(), F.col("range_start").asc_nulls_last(), F.col("id").asc()]


def vanilla_tables(tables: DataFrame, tables_of_extension: DataFrame, namespaces: DataFrame, classes: DataFrame) -> DataFrame:
    """Ordinary tables: not the extension's own, and no hypertables."""
    own = tables.filter(~F.col("schemaname").startswith(SYSTEM_PREFIX))
    plain = own.join(tables_of_extension.select(F.col("schema_name").alias("schemaname"), F.col("table_name").alias("tablename")), ["schemaname", "tablename"], "left_anti")
    return with_class(plain, namespaces, classes, "schemaname", "tablename")


def primary_keys(indexes: DataFrame) -> DataFrame:
    """A row for each column of a primary key: attrelid, attnum, key_seq, index_name, is_replica_ident and the options of its place."""
    each = indexes.filter("indisprimary").select("indrelid", "index_name", "indisreplident", "indoption", F.posexplode("indkey").alias("_p", "attnum"))
    return each.select(F.col("indrelid").alias("attrelid"), "attnum", (F.col("_p") + 1).alias("key_seq"), "index_name", F.col("indisreplident").alias("is_replica_ident"), F.get("indoption", F.col("_p")).alias("option"))


def table_columns(columns: DataFrame, types: DataFrame, indexes: DataFrame, dimensions: DataFrame | None = None) -> DataFrame:
    """The columns of tables, with type, primary key, index order and, where dimensions are given, the time-series part.

    columns: table_id, ordinal_position, column_name, udt_name, atttypmod, is_nullable ('YES', 'NO'), column_default, character_maximum_length.
    types: oid, typname. indexes: indrelid, index_name, indisprimary, indisreplident, indkey, indoption. dimensions: id, hypertable_id, column_name,
    aligned, interval_length.
    """
    typed = columns.join(types.select(F.col("oid").alias("type_oid"), F.col("typname").alias("udt_name")), "udt_name", "left")
    keys = primary_keys(indexes).withColumnsRenamed({"attrelid": "table_id", "attnum": "ordinal_position"})
    found = typed.join(keys, ["table_id", "ordinal_position"], "left")
    option = F.coalesce("option", F.lit(0))
    out = [
        "table_id", "ordinal_position", "column_name", "type_oid", "atttypmod", (F.col("is_nullable") == "YES").alias("nullable"), F.col("key_seq").isNotNull().alias("is_primary_key"), "key_seq",
        "column_default", F.coalesce("is_replica_ident", F.lit(False)).alias("is_replica_ident"), "index_name", F.when(option.bitwiseAND(1) == 1, "DESC").otherwise("ASC").alias("sort_order"),
        F.when(option.bitwiseAND(2) == 2, "NULLS FIRST").otherwise("NULLS LAST").alias("nulls_order"),
    ]
    if dimensions is None:
        return found.select(*out, "character_maximum_length")
    ranked = dimensions.withColumn("dim_seq", F.rank().over(Window.partitionBy("hypertable_id").orderBy("id")))
    dims = ranked.select(F.col("hypertable_id").alias("table_id"), "column_name", "aligned", "interval_length", "dim_seq")
    found = found.join(dims, ["table_id", "column_name"], "left")
    is_dim = F.col("dim_seq").isNotNull()
    return found.select(*out, is_dim.alias("is_dimension"), F.coalesce("aligned", F.lit(False)).alias("dim_aligned"), F.when(F.col("interval_length").isNull(), "space").otherwise("time").alias("dim_type"), "dim_seq", "character_maximum_length")


def types(found: DataFrame, namespaces: DataFrame, search_path: DataFrame, enums: DataFrame, oids: list[int] | None = None) -> DataFrame:
    """The first type of each name in the search path (schema, rank), pseudo types left out, enums with their labels; all or those of the oids."""
    spaces = namespaces.join(search_path, F.col("nspname") == F.col("schema")).select(F.col("oid").alias("_ns"), "nspname", "rank")
    labels = enums.groupBy(F.col("enumtypid").alias("_e")).agg(F.transform(F.array_sort(F.collect_list(F.struct("enumsortorder", "enumlabel"))), lambda x: x["enumlabel"]).alias("enum_values"))
    rows = found.filter("typtype <> 'p'") if oids is None else found.filter((F.col("typtype") != "p") & F.col("oid").isin(oids))
    rows = rows.join(spaces, F.col("typnamespace") == F.col("_ns")).drop("_ns").join(labels, F.col("oid") == F.col("_e"), "left").drop("_e")
    first = F.row_number().over(Window.partitionBy("typname").orderBy("rank", "oid"))
    return rows.withColumn("_n", first).filter("_n = 1").drop("_n")


def composite_fields(attributes: DataFrame, classes: DataFrame) -> DataFrame:
    """The fields of all composite types: type_oid, attnum, attname, atttypid, atttypmod, attnotnull; dropped and system ones left out."""
    of = classes.select(F.col("oid").alias("attrelid"), F.col("reltype").alias("type_oid")).filter("type_oid <> 0")
    return attributes.filter((F.col("attnum") > 0) & ~F.col("attisdropped")).join(of, "attrelid").select("type_oid", "attnum", "attname", "atttypid", "atttypmod", "attnotnull")


def published(publication_tables: DataFrame, publication: str) -> DataFrame:
    return publication_tables.filter(F.col("pubname") == publication).select("schemaname", "tablename")


def is_published(publication_tables: DataFrame, publication: str, schema: str, table: str) -> bool:
    return not published(publication_tables, publication).filter((F.col("schemaname") == schema) & (F.col("tablename") == table)).isEmpty()


def publication_exists(publications: DataFrame, publication: str) -> bool:
    return not publications.filter(F.col("pubname") == publication).isEmpty()


def owner_found(users: DataFrame, session_user: str, owner: Column) -> DataFrame:
    """Which rows of users the session's user owns: the user looked up by name, left so that an unknown one gives no row."""
    session = users.sparkSession.range(1).select(F.lit(session_user).alias("username"))
    return session.join(users, F.col("username") == F.col("usename"), "left").filter(owner == F.col("usesysid"))


def replication_slot(slots: DataFrame, name: str) -> dict | None:
    """plugin, slot_type, restart_lsn, confirmed_flush_lsn of a slot, or None. A slot that has no restart position cannot be used."""
    row = slots.filter(F.col("slot_name") == name).select("plugin", "slot_type", "restart_lsn", "confirmed_flush_lsn").first()
    if row is None:
        return None
    if row["restart_lsn"] is None:
        raise ValueError(f"replication slot {name} has no restart position")
    return row.asDict()


def uncompressed_of(tables: DataFrame) -> DataFrame:
    """compressed_id, origin_id: each hypertable that holds another's compressed rows, and that other."""
    return tables.filter("compressed_hypertable_id IS NOT NULL").select(F.col("compressed_hypertable_id").alias("compressed_id"), F.col("id").alias("origin_id"))


def origin_hypertables(chunks_: DataFrame, tables: DataFrame) -> DataFrame:
    """chunk_id, hypertable_id, origin_id, schema_name, table_name: the hypertable that a chunk's rows belong to, also where the chunk is compressed."""
    found = chunks_.select(F.col("id").alias("chunk_id"), "hypertable_id").join(uncompressed_of(tables), F.col("hypertable_id") == F.col("compressed_id"), "left")
    found = found.select("chunk_id", "hypertable_id", F.coalesce("origin_id", "hypertable_id").alias("origin_id"))
    return found.join(tables.select(F.col("id").alias("origin_id"), "schema_name", "table_name"), "origin_id")


def by_name(tables: DataFrame, names: DataFrame) -> DataFrame:
    """Entities of the names (schema_name, table_name)."""
    return tables.join(names, ["schema_name", "table_name"])


def by_id(tables: DataFrame, ids: DataFrame) -> DataFrame:
    return tables.join(ids.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")


def replicated_chunks(chunks_: DataFrame, tables: DataFrame, selected: Column) -> DataFrame:
    """Chunks that are not dropped, of hypertables that are selected."""
    return chunks_.filter("NOT dropped").join(tables.filter(selected).select(F.col("id").alias("hypertable_id")), "hypertable_id", "left_semi")


def initial_tables(chunks_: DataFrame, vanilla: DataFrame) -> DataFrame:
    """What a publication starts with: chunks and ordinary tables (schema_name, table_name)."""
    return chunks_.select("schema_name", "table_name", F.lit("chunk").alias("kind")).unionByName(vanilla.select("schema_name", "table_name", F.lit("vanilla").alias("kind")))


def decomposed_hypertables(log: DataFrame, side: str = "new") -> DataFrame:
    """Typed columns of the log's hypertable rows (tuples as maps of text)."""
    kinds = {"id": "int", "schema_name": "string", "table_name": "string", "associated_schema_name": "string", "associated_table_prefix": "string", "compression_state": "smallint", "compressed_hypertable_id": "int"}
    return _decomposed(log, side, kinds)


def decomposed_chunks(log: DataFrame, side: str = "new") -> DataFrame:
    """Typed columns of the log's chunk rows."""
    kinds = {"id": "int", "hypertable_id": "int", "schema_name": "string", "table_name": "string", "compressed_chunk_id": "int", "dropped": "boolean", "status": "int"}
    return _decomposed(log, side, kinds)


def _decomposed(log: DataFrame, side: str, kinds: dict[str, str]) -> DataFrame:
    return log.select("lsn", "op", *[F.col(side)[c].cast(k).alias(c) for c, k in kinds.items()])


def catalog_changes(log: DataFrame, relation: str, decomposed) -> DataFrame:
    """The changes that the log's rows of a catalog relation make, deletes read from their old tuple: what `catalog.versions` takes."""
    rows = log.filter(relation_class(F.col("namespace"), F.col("relation")) == relation)
    return decomposed(rows.filter("op <> 'd'")).unionByName(decomposed(rows.filter("op = 'd'"), "old"))


def routed(log: DataFrame) -> DataFrame:
    """Each log row's handler: hypertable and chunk rows keep up the catalog, internal ones are chunks' rows, others ordinary tables'."""
    return log.withColumn("handler", relation_class(F.col("namespace"), F.col("relation")))


def schema_versions(relations: DataFrame) -> DataFrame:
    """Relation messages (relation_id, lsn, columns) as versions of tables' columns; a message that repeats what holds is none."""
    w = Window.partitionBy("relation_id").orderBy("lsn")
    changed = relations.withColumn("_before", F.lag("columns").over(w)).filter(~F.col("columns").eqNullSafe(F.col("_before"))).drop("_before")
    return changed.select("relation_id", "columns", F.col("lsn").alias("valid_from_lsn"), F.lead("lsn").over(w).alias("valid_to_lsn"))


def column_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """table_id, name, change, new_name: added, dropped, renamed and changed columns, distributed over tables.

    Columns pair by name; of those left, an old and a new one of the same shape at the same place among the columns left are a rename.
    """
    o = old.select("table_id", "name", F.col("type").alias("old_type"), F.col("position").alias("old_position"))
    n = new.select("table_id", "name", F.col("type").alias("new_type"), F.col("position").alias("new_position"))
    both = o.join(n, ["table_id", "name"], "full_outer")
    changed = both.filter("old_type <> new_type").select("table_id", "name", F.lit("changed").alias("change"), F.lit(None).cast("string").alias("new_name"))
    place = lambda c: F.row_number().over(Window.partitionBy("table_id").orderBy(c))
    gone = both.filter("new_type IS NULL").select("table_id", F.col("name").alias("old_name"), "old_type", place("old_position").alias("_p"))
    come = both.filter("old_type IS NULL").select("table_id", F.col("name").alias("new_name"), "new_type", place("new_position").alias("_p"))
    left = gone.join(come, ["table_id", "_p"], "full_outer")
    same = F.coalesce(F.col("old_type") == F.col("new_type"), F.lit(False))
    parts = F.when(same, F.array(F.struct(F.col("old_name").alias("name"), F.lit("renamed").alias("change"), F.col("new_name")))).otherwise(
        F.filter(
            F.array(F.struct(F.col("old_name").alias("name"), F.lit("dropped").alias("change"), F.lit(None).cast("string").alias("new_name")), F.struct(F.col("new_name").alias("name"), F.lit("added").alias("change"), F.lit(None).cast("string").alias("new_name"))),
            lambda x: x["name"].isNotNull(),
        )
    )
    return changed.unionByName(left.select("table_id", F.explode(parts).alias("x")).select("table_id", "x.*"))


def unreadable(tables: DataFrame, selected: Column) -> DataFrame:
    """Selected tables that cannot be followed: (table, reason), for replica identities by index or missing privileges."""
    reason = F.when(F.col("relreplident") == "i", "replica identity by index").when(~F.coalesce("may_select", F.lit(False)), "no select privilege")
    return tables.filter(selected).select(canonical(F.col("schema_name"), F.col("table_name")).alias("table"), reason.alias("reason")).filter("reason IS NOT NULL")

