from podium.sinks.files import preview, write_layer
from podium.sinks.jdbc import write_jdbc
from podium.sinks.topic import write_topic

__all__ = ["preview", "write_jdbc", "write_layer", "write_topic"]
