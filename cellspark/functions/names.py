"""Column functions on read names, cell ids and sample names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_name(ligation: Column, rt: Column, umi: Column, original: Column) -> Column:
    return F.concat(F.lit("@"), ligation, F.lit("-"), rt, F.lit(","), umi, F.lit(","), original)


def parse_read_name(name: Column) -> dict[str, Column]:
    cell = F.split_part(name, F.lit(","), F.lit(1))
    return {"ligation": F.split_part(cell, F.lit("-"), F.lit(1)), "rt": F.split_part(cell, F.lit("-"), F.lit(2)), "umi": F.split_part(name, F.lit(","), F.lit(2))}


def cell_parts(cell_id: Column) -> dict[str, Column]:
    parts = F.split(cell_id, "[.]", 3)
    return {"pcr_batch": F.get(parts, 0), "ligation_barcodes": F.get(parts, 1), "rt_barcodes": F.get(parts, 2)}


def decode_sample(sample: Column) -> dict[str, Column]:
    """x_<human>_<mouse>_<name...>"""
    parts = F.split(sample, "_")
    return {"human": F.get(parts, 1) == "1", "mouse": F.get(parts, 2) == "1", "sample": F.array_join(F.slice(parts, 4, F.greatest(F.size(parts), F.lit(1))), "_")}
