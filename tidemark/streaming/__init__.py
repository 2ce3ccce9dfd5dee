from tidemark.streaming.logs import arriving_log, deliver_log
from tidemark.streaming.readiness import await_verdict, watch_domain, with_expected

__all__ = ["arriving_log", "await_verdict", "deliver_log", "watch_domain", "with_expected"]
