"""Facts from free text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.functions.text import iso_date, search_group

# How a sensor and its installation date are written in a description.
SENSOR_GUARD = r"Capteur(?:\s+de)?\s+temp[eé]rature\s+n°[^(]+\(\d{4}[-/]\d{2}[-/]\d{2}\)"
SENSOR_SERIAL = r"Capteur(?:\s+de)?\s+temp[eé]rature\s+n°([^\s(]+)\s*\("
SENSOR_DATE = r"\((\d{4}[-/]\d{2}[-/]\d{2})\)"
SERIAL_UNREADABLE = "..?.."


def extract_facts(df: DataFrame, text: str, guard: str, fields: Mapping[str, Column]) -> DataFrame:
    """Keep the rows whose text matches the guard (case counts) and add the extracted fields."""
    return df.filter(F.col(text).rlike(guard)).withColumns(dict(fields))


def sensor_facts(text: str, strict: bool = True) -> dict[str, Column]:
    """Serial number, with a placeholder when unreadable, and the first parenthesised date."""
    return {
        "serial_number": F.coalesce(search_group(text, SENSOR_SERIAL), F.lit(SERIAL_UNREADABLE)),
        "install_date": iso_date(search_group(text, SENSOR_DATE), strict),
    }
