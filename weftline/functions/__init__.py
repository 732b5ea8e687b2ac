"""Package part of weftline."""
