"""Analytics over security logs, as DataFrame-to-DataFrame operators."""
