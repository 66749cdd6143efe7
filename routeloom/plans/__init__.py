"""The cleaning plan and the two reports, built from operators."""
