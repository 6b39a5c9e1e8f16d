"""Latest-wins over arriving quarters as a stateful stream, with an audit of what was superseded."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key string, version string, payload string, status string, winning_version string"


def _decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State of a key: its greatest version and the rows of it sent out so far.

    Rows of the greatest version are `kept` as they come. When a greater one arrives, rows sent before
    are sent again as `superseded`; rows that arrive too late are `superseded` at once.
    """
    best, sent = state.get if state.exists else (None, [])
    sent, out = list(sent), []
    for rows in batches:
        for version, payload in zip(rows["version"], rows["payload"]):
            if best is None or version > best:
                out += [(key[0], best, p, "superseded", version) for p in sent]
                best, sent = version, []
            if version == best:
                sent.append(payload)
            out.append((key[0], version, payload, "kept" if version == best else "superseded", best))
    # rows kept earlier in this batch but superseded within it appear as both; the last status holds
    state.update((best, sent))
    yield pd.DataFrame(out, columns=["key", "version", "payload", "status", "winning_version"])


def latest_wins_stream(rows: DataFrame) -> DataFrame:
    """A stream `(key, version, payload)` as status events `kept` or `superseded` with the winning version.

    Versions compare as strings. Folding the events by (key, version, payload), the last one holding,
    gives the batch operator's two tables. State per key is one version's rows.
    """
    return rows.groupBy("key").applyInPandasWithState(_decide, OUTPUT, "best string, sent array<string>", "append", GroupStateTimeout.NoTimeout)
