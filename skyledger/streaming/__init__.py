from skyledger.streaming.log import follow_flights, read_flight_log, read_rejects, start_from_log, start_log
from skyledger.streaming.questions import (
    STREAM_QUESTIONS,
    Upkeep,
    read_question,
    start_all,
    start_question,
    start_summary,
)
from skyledger.streaming.runner import AVAILABLE_NOW, EVERY_TEN_SECONDS, start_query, start_rejects
from skyledger.streaming.stored import read_state, start_state
from skyledger.streaming.states import running_best, running_mean, running_visits

__all__ = [
    "AVAILABLE_NOW", "EVERY_TEN_SECONDS", "STREAM_QUESTIONS", "Upkeep", "follow_flights", "read_flight_log", "read_question", "read_rejects", "read_state", "running_best",
    "running_mean", "running_visits", "start_all", "start_from_log", "start_log", "start_query", "start_question", "start_rejects", "start_state", "start_summary",
]
