"""The moment test messages count their seconds from."""

from datetime import datetime, timedelta, timezone

T0 = datetime(2024, 1, 15, 10, 30, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)
