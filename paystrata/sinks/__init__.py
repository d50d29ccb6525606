"""Writers: messages, sorted copies, keyed tables."""
