from podium.streaming.console import to_console, write_console
from podium.streaming.epochs import EpochLog, once, query_id
from podium.streaming.fanout import (
    fan_out,
    latest_snapshot,
    to_jdbc,
    to_table,
    to_topic,
)
from podium.streaming.stop import Stop, Stopped
from podium.streaming.watch import DataLoss, FeedWatch

__all__ = [
    "DataLoss",
    "EpochLog",
    "FeedWatch",
    "Stop",
    "Stopped",
    "fan_out",
    "latest_snapshot",
    "once",
    "query_id",
    "to_console",
    "to_jdbc",
    "to_table",
    "to_topic",
    "write_console",
]
