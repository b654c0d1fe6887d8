"""Sources and sinks: corpus readers, log readers, writers, OCR/HTML parsers."""
