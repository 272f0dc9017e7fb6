"""Raw actions of chosen sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.operators.bounded import BROADCAST_ROWS, own_shuffle
from visitloom.schemas import SESSION_DETAIL, shape_result


def session_detail_filtered(
    actions: DataFrame, sessions: DataFrame, by_session: bool = False
) -> DataFrame:
    """Actions of the filtered sessions.

    A semi join: the session side is unique, and Spark may split the actions
    of a skewed session over several tasks. ``by_session``: the actions are stored in buckets by
    session and the sessions were rolled up from them, so both lie where they are needed and
    nothing is shuffled.
    """
    ids = sessions.select("session_id")
    return actions.join(ids if by_session else own_shuffle(ids), "session_id", "left_semi")


def _ids(chosen: DataFrame, max_rows: int) -> DataFrame:
    ids = chosen.select("session_id")
    return F.broadcast(ids) if max_rows <= BROADCAST_ROWS else own_shuffle(ids)


def detail_of_few(actions: DataFrame, chosen: DataFrame, max_rows: int) -> DataFrame:
    """Actions of at most ``max_rows`` chosen sessions, each once.

    While ``max_rows`` is small the actions are not shuffled.
    """
    return actions.join(_ids(chosen, max_rows), "session_id", "left_semi")


def detail_of_each(actions: DataFrame, chosen: DataFrame, max_rows: int) -> DataFrame:
    """Actions per chosen row: a session chosen k times gives its actions k times."""
    return actions.join(_ids(chosen, max_rows), "session_id")


def restrict_to_ids(actions: DataFrame, ids: list[str], filtered: bool = False) -> DataFrame:
    """Literal form of the restriction, which the parquet reader can skip row groups by.

    Of more ids than a threshold Spark tells the reader only the least and the largest. ``filtered``:
    the table has Bloom filters of session_id, as ``store_actions`` writes them; then all ids are
    told, in groups within the threshold. Rows are still looked up in one set first.
    """
    session = F.col("session_id")
    if not ids:
        return actions.where(F.lit(False))
    kept = actions.where(session.isin(*ids))
    most = int(actions.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold", "10"))
    if filtered and len(ids) > most > 0:
        groups = [session.isin(*ids[i : i + most]) for i in range(0, len(ids), most)]
        kept = kept.where(reduce(Column.__or__, groups))
    return kept


def shape_detail(detail: DataFrame, taskid: int) -> DataFrame:
    """Project actions to the ``session_detail`` result."""
    return shape_result(
        detail, SESSION_DETAIL, taskid, userid="user_id", sessionid="session_id", pageid="page_id"
    )
