"""Input: files of log lines, plain or compressed."""
