"""Publish messages to a topic."""

from pyspark.sql import DataFrame


def write_topic(
    messages: DataFrame,
    topic: str,
    servers: list[str] | None = None,
    fmt: str = "kafka",
    **options: str,
) -> None:
    """Append ``key``, ``value`` messages to a broker's topic or a directory.

    Each call appends all its messages: publishing a table twice, or a second
    try after a failure, repeats them in the topic.
    """
    if fmt == "kafka":
        options = {
            "kafka.bootstrap.servers": ",".join(servers or []),
            "topic": topic,
            **options,
        }
        messages.write.format("kafka").options(**options).save()
        return
    if fmt == "text":
        messages = messages.select("value")
    messages.write.format(fmt).options(**options).mode("append").save(topic)
