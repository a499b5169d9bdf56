from trendlens.streaming.control import request_reset, set_control
from trendlens.streaming.fold import EpochFold
from trendlens.streaming.query import Step, replay, start_stream
from trendlens.streaming.state import EpochStore

__all__ = ["EpochFold", "EpochStore", "Step", "replay", "request_reset", "set_control", "start_stream"]
