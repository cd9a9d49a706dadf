"""Readers: timetable text tables, archives, real-time feeds, exported snapshots."""
