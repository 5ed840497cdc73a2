"""No streaming operators.

The work rebuilt here has no stream source, event time or state. The column functions and
``operators.encode.lookup`` with a fitted vocabulary are stateless, so they also run on a
streaming DataFrame as they are (see ``tests/test_streaming.py``).
"""
