"""Readers, wire decoding, sinks and staging."""
