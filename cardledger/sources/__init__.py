"""Reading and writing: fixed-width files, snapshots, exchange files, messages."""
