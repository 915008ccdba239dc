"""Typed source rows -> VARIANT row images -> clean tables (batch path).

A snapshot read of a source table is the same as a change feed of ``op='r'``
events (S4), so the batch path shares the cleaners with the streaming path:
rows are turned into the JSON image the feed would carry and cleaned from
there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import clean as C


def as_image(df: DataFrame, name: str = "after", keep: list[str] | None = None) -> DataFrame:
    """All columns as one VARIANT row image, built straight from the struct
    (``to_variant_object``: no JSON text round trip; nulls stay JSON null)."""
    img = F.to_variant_object(F.struct(*df.columns))
    return df.select(*(keep or []), img.alias(name))


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("_error").isNull()).drop("_error")


def clean_customers_snapshot(src: DataFrame) -> DataFrame:
    return good(C.clean_customers(as_image(src)))


def clean_orders_snapshot(src: DataFrame) -> DataFrame:
    return good(C.clean_orders(as_image(src)))


def document_image(docs: DataFrame, name: str = "doc") -> DataFrame:
    """Document JSON text (``doc_json``) parsed once into a VARIANT image."""
    return docs.select(F.parse_json("doc_json").alias(name))


def clean_documents_snapshot(docs: DataFrame, collection: str) -> DataFrame:
    return good(C.DOC_CLEANERS[collection](document_image(docs))).drop("_doc")
