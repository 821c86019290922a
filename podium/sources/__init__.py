from podium.sources.files import layer_path, read_landing_csv, read_layer
from podium.sources.jdbc import jdbc_options, read_jdbc
from podium.sources.pinned import pinned_schema, read_feed
from podium.sources.topic import read_topic, topic_options

__all__ = [
    "jdbc_options",
    "layer_path",
    "pinned_schema",
    "read_feed",
    "read_jdbc",
    "read_landing_csv",
    "read_layer",
    "read_topic",
    "topic_options",
]
