"""Structured Streaming forms of the daily aggregate, late rows, sessions and live quality."""

from stratus.streaming.daily import closed_window_stream, daily_event_stream, feature_stream, run_batches
from stratus.streaming.late import LateAwareDays
from stratus.streaming.live_quality import LiveQuality
from stratus.streaming.sessions import SessionStream, session_windows

__all__ = ["LateAwareDays", "LiveQuality", "SessionStream", "closed_window_stream", "daily_event_stream", "feature_stream", "run_batches",
           "session_windows"]
