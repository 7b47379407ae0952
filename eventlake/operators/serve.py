"""Gold rows -> keyed event documents, and keyed upsert with ``$set`` semantics.

* :func:`normalise_rows` – header keys stripped + lower-cased, values stripped.
* :func:`build_documents` – alias pick per field, ``_id`` = md5 of
  ``nome|data|hora|cidade|origem``, nested ``lugar`` (``estado`` always null).
* :func:`upsert` – one survivor per key in the batch (fix: the original bulk write
  was unordered), then a full outer join: every field the batch carries replaces
  the stored one (nulls too, the struct whole); stored-only fields are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import alias_pick, doc_id, normalize_key, py_strip
from eventlake.operators.joins import first_by_order
from eventlake.schemas import DOC_ALIASES


def normalise_rows(df: DataFrame) -> DataFrame:
    """Keys ``strip().lower()``; string values stripped (one projection)."""
    out = df.toDF(*[normalize_key(c) for c in df.columns])
    return out.select(*[py_strip(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                        for c, t in out.dtypes])


def build_documents(rows: DataFrame, source_key: Column | str) -> DataFrame:
    """Normalised gold rows -> documents (``DOC_SCHEMA``)."""
    key = F.lit(source_key) if isinstance(source_key, str) else source_key
    nome, cidade, local = (alias_pick(rows, DOC_ALIASES[k]) for k in ("nome", "cidade", "local"))
    data, hora, origem = (alias_pick(rows, DOC_ALIASES[k]) for k in ("data", "hora", "origem"))
    return rows.select(
        doc_id(nome, data, hora, cidade, origem).alias("_id"),
        nome.alias("nome"),
        data.alias("data"),
        hora.alias("hora_local"),
        F.struct(cidade.alias("cidade"), local.alias("venue"),
                 F.lit(None).cast("string").alias("estado")).alias("lugar"),
        origem.alias("origem"),
        key.alias("source_key"),
    )


def batch_survivors(batch: DataFrame, key: str = "_id",
                    order: list[Column] | None = None) -> DataFrame:
    """One row per key; default order: latest ``source_key``, then smallest venue."""
    if order is None:
        order = [F.col("source_key").desc_nulls_last()]
        if "lugar" in batch.columns:
            order.append(F.col("lugar.venue").asc_nulls_last())
    return first_by_order(batch, [key], order)


def upsert(target: DataFrame, batch: DataFrame, key: str = "_id",
           order: list[Column] | None = None) -> DataFrame:
    """New state of ``target`` after upserting ``batch`` on ``key``."""
    batch = batch_survivors(batch, key, order)
    b = batch.alias("b")
    t = target.alias("t")
    joined = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    hit = F.col(f"b.{key}").isNotNull()
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"b.{key}"), F.col(f"t.{key}")).alias(key))
        elif c in batch.columns:
            cols.append(F.when(hit, F.col(f"b.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c))
        else:
            cols.append(F.col(f"t.`{c}`").alias(c))
    cols += [F.col(f"b.`{c}`").alias(c) for c in batch.columns if c not in target.columns]
    return joined.select(*cols)


def upsert_stats(target: DataFrame, batch: DataFrame, key: str = "_id") -> DataFrame:
    """One row: batch rows, distinct keys, keys already stored (updates), new keys."""
    keys = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    flagged = keys.join(target.select(key).withColumn("_hit", F.lit(1)), key, "left")
    return flagged.agg(
        F.sum("_n").alias("n_batch_rows"), F.count(F.lit(1)).alias("n_keys"),
        F.count("_hit").alias("n_updates"),
        (F.count(F.lit(1)) - F.count("_hit")).alias("n_inserts"))


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Nested ``lugar`` -> ``lugar_cidade``, ``lugar_venue``, ``lugar_estado``."""
    rest = [c for c in docs.columns if c != "lugar"]
    return docs.select(*rest, F.col("lugar.cidade").alias("lugar_cidade"),
                       F.col("lugar.venue").alias("lugar_venue"),
                       F.col("lugar.estado").alias("lugar_estado"))
