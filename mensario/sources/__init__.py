"""Reading and writing the layers of the lake."""
