"""Pipeline operators: pure ``DataFrame -> DataFrame`` functions.

They only build logical plans; the same function serves batch and streaming
inputs wherever Structured Streaming supports the underlying operator.
"""
