"""Monthly customer feature books from invoice and payment files, on Spark."""
