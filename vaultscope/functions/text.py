"""Text formatters over result columns (FN-3..FN-8, FN-11).

All are built-in column expressions (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's text forms.
DISK_TEXT = "[model='%s', serialNumber='%s']"
NO_FAILURES = "(No failures)"
STRIP_CHARS = '()"'


def tuple_text(*cols: str | Column) -> Column:
    """FN-3: ``(a,b,c)`` as a result tuple prints."""
    return F.concat(F.lit("("), F.concat_ws(",", *[F.col(c) if isinstance(c, str) else c for c in cols]), F.lit(")"))


def disk_text(model: str | Column = "model", serial: str | Column = "serial_number") -> Column:
    """FN-4: ``[model='..', serialNumber='..']``."""
    return F.format_string(DISK_TEXT, model, serial)


def disks_text(disks: str | Column) -> Column:
    """FN-5: array<struct<model, serial_number>> joined with ``", "``."""
    arr = F.col(disks) if isinstance(disks, str) else disks
    return F.array_join(F.transform(arr, lambda d: disk_text(d["model"], d["serial_number"])), ", ")


def rank_piece(vault: str | Column, failures: str | Column, details: str | Column) -> Column:
    """FN-6 building block: ``, <vault>, <failures> (<details>)`` or
    ``(No failures)`` when the detail text is empty."""
    det = F.col(details) if isinstance(details, str) else details
    tail = F.when(F.coalesce(det, F.lit("")) == "", F.lit(" " + NO_FAILURES)).otherwise(F.concat(F.lit(" ("), det, F.lit(")")))
    return F.concat(F.lit(", "), F.col(vault).cast("string") if isinstance(vault, str) else vault.cast("string"),
                    F.lit(", "), F.col(failures).cast("string") if isinstance(failures, str) else failures.cast("string"), tail)


def strip_chars(c: str | Column, chars: str = STRIP_CHARS) -> Column:
    """FN-7: drop ``(``, ``)`` and ``"``."""
    return F.translate(F.col(c) if isinstance(c, str) else c, chars, "")


def split_fields(c: str | Column, sep: str = ",") -> Column:
    """FN-8 / PRJ-1: split keeping empty fields (``String.split(sep, -1)``)."""
    return F.split(F.col(c) if isinstance(c, str) else c, sep, -1)


def record_text(name: str, *cols: str) -> Column:
    """FN-11: ``Name{a=1, b=2}`` debug text."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.lit(("" if i == 0 else ", ") + f"{c}="), F.col(c).cast("string")]
    return F.concat(F.lit(name + "{"), *parts, F.lit("}"))


# One ranked vault of a ranking line: vault, failures, disks.  Disk texts hold commas.
RANKED_RE = r", (-?\d+), (\d+) \((No failures|(?:\[model='.*?', serialNumber='.*?'\](?:, )?)*)\)"


def ranking_columns(line: str | Column, k: int = 10) -> list[Column]:
    """A ranking line (:func:`rank_piece`) as columns: ts, then vault_idK, failuresK and
    disk_detailsK for K = 1..k, null beyond the window's last rank."""
    text = F.col(line) if isinstance(line, str) else line
    vault, failures, disks = (F.regexp_extract_all(text, F.lit(RANKED_RE), F.lit(i)) for i in (1, 2, 3))
    out = [F.substring_index(text, ",", 1).alias("ts")]
    for i in range(k):
        out += [F.get(vault, F.lit(i)).cast("int").alias(f"vault_id{i + 1}"), F.get(failures, F.lit(i)).cast("long").alias(f"failures{i + 1}"),
                F.get(disks, F.lit(i)).alias(f"disk_details{i + 1}")]
    return out
