"""Incremental form of the per-game sentiment table over a growing folder."""

from plaudit.streaming.live import game_sentiment_stream, start_game_sentiment

__all__ = ["game_sentiment_stream", "start_game_sentiment"]
