from tessera.cli import main

main()
