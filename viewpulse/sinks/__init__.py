"""Writers: result tables and keyed real-time tables."""
