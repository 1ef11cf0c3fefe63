"""Test helper: back-date a file for the retention tests."""

from quaylake.sources import inventory as inv


def set_mtime(spark, path, mtime_ms):
    fs, jpath = inv._fs(spark, path)
    fs.setTimes(jpath, int(mtime_ms), -1)
