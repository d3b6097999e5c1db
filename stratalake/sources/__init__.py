"""Reading landing files and relational extracts, typed bronze views, writing tables."""
