"""Document numbers, object paths and rendered members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightloom.functions.keys import _col


def bill_of_lading_number(shipment: Column | str) -> Column:
    """``BL-`` and the last eight characters."""
    return F.concat(F.lit("BL-"), F.right(_col(shipment), F.lit(8)))


def customs_number(shipment: Column | str) -> Column:
    """``CC-EU-`` and the last eight characters."""
    return F.concat(F.lit("CC-EU-"), F.right(_col(shipment), F.lit(8)))


def import_number(shipment: Column | str) -> Column:
    """``DE`` and the last twelve characters in capitals without dashes."""
    tail = F.upper(F.right(_col(shipment), F.lit(12)))
    return F.concat(F.lit("DE"), F.replace(tail, F.lit("-"), F.lit("")))


def phytosanitary_number(shipment: Column | str) -> Column:
    """``PHYTO-`` and the last six characters in capitals."""
    return F.concat(F.lit("PHYTO-"), F.upper(F.right(_col(shipment), F.lit(6))))


def object_path(folder: str, key: Column | str, name: str) -> Column:
    """Path of a document inside its bucket."""
    return F.concat(F.lit(folder + "/"), _col(key), F.lit(f"/{name}.pdf"))


def position_member(latitude: Column, longitude: Column, temperature: Column, moment: Column) -> Column:
    """One point of a route as JSON text."""
    return F.to_json(
        F.struct(
            latitude.cast("double").alias("lat"),
            longitude.cast("double").alias("lon"),
            temperature.cast("double").alias("temp"),
            F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        )
    )
