from harkline.cli import main

main()
