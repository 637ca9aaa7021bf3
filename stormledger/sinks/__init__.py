"""Writers. All output is a folder of part files."""
