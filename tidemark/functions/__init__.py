from tidemark.functions.blanks import any_blank, is_blank, normalise_space
from tidemark.functions.scopes import Scope, duplicate_scope, null_scope
from tidemark.functions.times import (
    as_date, before_cut_off, day_in, local_time_of_day, next_ingest_at, previous_day,
    run_variables, status_time,
)

__all__ = [
    "Scope", "any_blank", "as_date", "before_cut_off", "day_in", "duplicate_scope", 
    "is_blank", "local_time_of_day", "next_ingest_at", "normalise_space", "null_scope",
    "previous_day", "run_variables", "status_time",
]
