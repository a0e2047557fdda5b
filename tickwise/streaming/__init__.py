from tickwise.streaming.bars_stream import daily_bars_stream, start_bars_sink  # noqa: F401
