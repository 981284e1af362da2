"""Table operators: frames in, frames out, no action inside unless its text says so."""
