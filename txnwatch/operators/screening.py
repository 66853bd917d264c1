"""JOIN-1 / FLT-9: static blacklist screening on user, merchant or IP."""

from __future__ import annotations

from pyspark.sql import DataFrame


def screen(txns: DataFrame, blacklist: DataFrame, key: str, keep: str = "hits",
           list_key: str | None = None) -> DataFrame:
    """``keep='hits'``: transactions whose ``key`` is listed (semi join);
    ``keep='pass'``: those that are not (anti join).

    A plain join on the de-duplicated list: Spark broadcasts it when the bytes it
    measures are below its threshold and shuffles both sides otherwise.  A null key
    is never a hit.
    """
    if keep not in ("hits", "pass"):
        raise ValueError("keep must be 'hits' or 'pass'")
    list_key = list_key or key
    listed = blacklist.select(blacklist[list_key].alias(key)).where(f"`{key}` IS NOT NULL").distinct()
    return txns.join(listed, on=key, how="left_semi" if keep == "hits" else "left_anti")
