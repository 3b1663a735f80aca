"""Chat history queries and delivery of answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.text import citations_valid, slices


def recent_sessions(sessions: DataFrame, n: int = 5) -> DataFrame:
    return sessions.select("id", "title", "created_at").orderBy(F.col("created_at").desc(), "id").limit(n)


def recent_messages(messages: DataFrame, n: int = 5, preview: int = 50) -> DataFrame:
    """The last messages, their text cut to a preview."""
    return (
        messages.orderBy(F.col("created_at").desc(), "session_id")
        .limit(n)
        .select("session_id", "role", F.left("content", F.lit(preview)).alias("content"), "created_at")
    )


def unknown_roles(messages: DataFrame) -> DataFrame:
    """Messages whose role is not one of the known roles."""
    return messages.filter(~F.col("role").isin(fv.MESSAGE_ROLES))


def check_citations(answers: DataFrame, text: str = "text", blocks: str = "blocks") -> DataFrame:
    """Add ``citations_ok``."""
    return answers.withColumn("citations_ok", citations_valid(F.col(text), F.col(blocks)))


def with_note(text: Column, marker: str, note: str) -> Column:
    """The text, with a closing note unless the marker is already in it."""
    return F.when(F.contains(text, F.lit(marker)), text).otherwise(F.concat(text, F.lit(note)))


def deliver(
    answers: DataFrame, text: str = "text", width: int = fv.DELIVERY_CHARS,
    marker: str | None = None, note: str | None = None,
) -> DataFrame:
    """Pieces of every answer in order: the text in slices, then the note as one piece.

    The note comes last unless its marker already occurs in the answer.
    """
    pieces = slices(F.col(text), width)
    if marker and note:
        missing = F.when(~F.contains(F.col(text), F.lit(marker)), F.array(F.lit(note))).otherwise(
            F.array().cast("array<string>"))
        pieces = F.concat(pieces, missing)
    kept = [c for c in answers.columns if c != text]
    return answers.select(*kept, F.posexplode(pieces).alias("piece_no", "piece"))
