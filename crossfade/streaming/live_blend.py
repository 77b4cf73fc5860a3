"""Final recommendations refreshed for every user with new events."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from crossfade.operators.serving import blend, offline_recs, online_recs
from crossfade.streaming.history import write_batches

BLEND_SCHEMA = "user_id long, track_id long, rank int"


def stream_blend(
    history: DataFrame,
    similar: DataFrame,
    personal: DataFrame,
    top: DataFrame,
    path: str,
    checkpoint: str,
    k: int = 50,
    num_events: int = 3,
    **trigger,
) -> StreamingQuery:
    """Blend the lists of the users in each micro-batch of ``stream_history`` output.

    ``similar``, ``personal`` and ``top`` are plain tables, read anew in every micro-batch.
    """

    def answer(rows: DataFrame) -> DataFrame:
        online = online_recs(rows, similar, k, num_events)
        offline = offline_recs(rows.select("user_id"), personal, top, k)
        return blend(online, offline, k)

    return write_batches(history, path, checkpoint, answer, **trigger)
